"""Gapless row numbers within groups of any size, and orders that both Spark and SQL can compute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scatter(key: Column, seed: int = 0) -> Column:
    """A reproducible pseudo-random hexadecimal order key; null keys share one value."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def prefix_digits(rows: int, block_rows: int) -> int:
    """Hexadecimal digits of `scatter` that cut `rows` into blocks of at most about `block_rows`."""
    digits = 0
    while rows > block_rows * 16**digits:
        digits += 1
    return digits


def number_rows(
    df: DataFrame, out: str, group: Sequence[str], block: str, order: Sequence[Column]
) -> DataFrame:
    """Add `out`: 0, 1, 2, ... within `group`, ordered by (`block`, `order`), without gaps.

    No task sees a whole group: rows are ordered inside (group, block), and a small table of block
    sizes gives each block its first number. `group` and `block` must not be null. Rows that are
    equal in `order` get their numbers in any order, so `order` should tell different rows apart.
    An empty table stays empty. `df` is computed twice and must give equal rows each time.
    """
    keys = [*group, block]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys, F.coalesce(F.sum("__rows").over(before), F.lit(0)).cast("long").alias("__start")
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__inside", F.row_number().over(inside) - 1)
        .join(starts, keys)
        .withColumn(out, F.col("__start") + F.col("__inside"))
        .drop("__start", "__inside")
    )
