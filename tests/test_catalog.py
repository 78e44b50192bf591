"""Registered queries against their SQL twins."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.verify import TABLES, canon

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    assert canon(rows, df.columns) == canon(res.fetchall(), names)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["season", "avg_shift", "crop_score", "stability_score", "observations"]
    df.collect()
