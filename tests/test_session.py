"""Session helpers."""

from types import SimpleNamespace

import pytest

from fieldcast import session


def test_shuffle_width_follows_input():
    assert session.shuffle_options(1)["spark.sql.shuffle.partitions"] == "200"
    assert session.shuffle_options(1000)["spark.sql.shuffle.partitions"] == "8000"
    assert session.shuffle_options(100_000)["spark.sql.shuffle.partitions"] == "40000"


def test_cluster_needs_a_shared_folder():
    fake = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    fake.conf = SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake)


def test_configured_folder_is_used():
    conf = SimpleNamespace(get=lambda key, default: "/shared/x")
    fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    assert session.scratch_dir(fake) == "/shared/x"


def test_checkpoint_cuts_lineage(spark):
    df = session.checkpoint(spark.range(10).withColumnRenamed("id", "k"))
    assert df.count() == 10 and "Scan ExistingRDD" in df._jdf.queryExecution().toString()
