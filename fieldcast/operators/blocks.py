"""Small reference sides of a known size, held as one array value per row.

Scoring every row against a small table is written as a higher-order function over an
array (a scalar subquery), so no join multiplies the rows.  The table's size is counted
first; beyond the limit it is cut into blocks that are scored one after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.session import checkpoint

BLOCK_ROWS = 5000


def blocks(df: DataFrame, key: str, per_block: int = BLOCK_ROWS) -> list[DataFrame]:
    """``df`` itself when it fits one block, else disjoint parts that together cover it.

    The rows are pinned, so that the count, the parts and every use of them agree and the
    table is computed only once.
    """
    df = checkpoint(df)
    rows = df.count()
    parts = -(-rows // per_block)
    if parts <= 1:
        return [df]
    slot = F.pmod(F.xxhash64(key), F.lit(parts))
    return [df.filter(slot == i) for i in range(parts)]


def attach(df: DataFrame, name: str, block: DataFrame, *cols: str | Column) -> DataFrame:
    """Add the block to every row of ``df`` as an array of structs.

    The array is a scalar subquery: it is computed once and reaches the tasks as one
    constant, not as a copy per row.
    """
    array = block.agg(F.collect_list(F.struct(*cols)).alias("a")).scalar()
    return df.withColumn(name, array)


def best_of(df: DataFrame, parts: list[DataFrame], cols: Sequence[str | Column],
            score: Callable[[Column], Column], out: str) -> DataFrame:
    """Smallest ``score(entry)`` struct over the entries of all blocks."""
    names = [f"_block{i}" for i in range(len(parts))]
    for name, part in zip(names, parts):
        df = attach(df, name, part, *cols)
    near = [F.array_min(F.transform(name, score)) for name in names]
    return df.withColumn(out, near[0] if len(near) == 1 else F.least(*near)).drop(*names)
