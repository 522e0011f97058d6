"""Joins the exposure tables are assembled with (C1-C8, A9, section 4.1 helper)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

_REDUCERS: dict[str, Callable[[str, str], Column]] = {
    "last": lambda c, seq: F.max_by(c, seq),
    "first": lambda c, seq: F.min_by(c, seq),
    "sum": lambda c, seq: F.sum(c),
    "mean": lambda c, seq: F.avg(c),
    "max": lambda c, seq: F.max(c),
    "min": lambda c, seq: F.min(c),
}


def keyed_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", null_match: bool = False
) -> DataFrame:
    """Equi-join on same-named keys; ``null_match=True`` lets NULL meet NULL.

    A left join keeps every match, so duplicate right keys fan out; use :func:`update_join` where
    the left row count must not change.
    """
    if not null_match:
        return left.join(right, on, how)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    match = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in on]
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in on])


def one_row_per_key(
    df: DataFrame,
    on: list[str],
    cols: list[str],
    tie: str = "last",
    seq: str = "seq",
    unique: bool = False,
) -> DataFrame:
    """Reduce to one row per key; duplicates are combined before the shuffle, so a hot key costs one
    row per task.

    Rows of one key with an equal ``seq`` are ordered by a hash of ``cols``, so that all columns come
    from the same row. ``unique=True`` vouches that there are none, which allows a hash aggregation.
    """
    reduce = _REDUCERS[tie]
    if tie not in ("last", "first") or unique:
        return df.groupBy(*on).agg(*[reduce(c, seq).alias(c) for c in cols])
    order = F.when(F.col(seq).isNotNull(), F.struct(seq, F.xxhash64(*cols)))
    return df.groupBy(*on).agg(*[reduce(c, order).alias(c) for c in cols])


def update_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    cols: list[str],
    tie: str = "last",
    seq: str = "seq",
    validate: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Set ``cols`` on the left rows from the matching right row; never changes the row count.

    With several matches the one with the highest ``seq`` wins, including its missing values; equal
    ``seq`` and ``unique`` are as in :func:`one_row_per_key`.
    ``validate=True`` runs a job that fails when ``seq`` is missing or repeated within a key.
    """
    if validate:
        bad = right.groupBy(*on).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(seq).alias("d")
        )
        if not bad.where("n <> d").isEmpty():
            raise ValueError(f"{seq} must be present and unique within each key")
    keep = [c for c in left.columns if c not in cols]
    return left.select(*keep).join(
        one_row_per_key(right, on, cols, tie, seq, unique), on, "left"
    )


def nearest_vintage(year: Column, vintages: list[int]) -> Column:
    """The vintage closest to a year; of two equally close ones the earlier."""
    ordered = sorted(vintages)
    pick = F.lit(ordered[-1])
    for low, high in reversed(list(zip(ordered, ordered[1:]))):
        pick = F.when(year * 2 <= low + high, F.lit(low)).otherwise(pick)
    return F.when(year.isNotNull(), pick)


def vintage_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    year: str,
    vintage: str,
    vintages: list[int],
) -> DataFrame:
    """Left join on ``on`` and the vintage closest to the row's year.

    The vintage list is a short parameter, so the choice is an expression and the join stays an
    equi-join on (keys, vintage).
    """
    tagged = left.withColumn(vintage, nearest_vintage(F.col(year), vintages))
    return tagged.join(right, [*on, vintage], "left")


def expand_interval(df: DataFrame, start: str, end: str, out: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive; an empty interval gives no row."""
    days = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end)))
    return df.withColumn(out, F.explode(days))


def map_distinct(df: DataFrame, keys: list[str], fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a costly step once per distinct key, then join its result back (section 4.1).

    ``fn`` gets one row per distinct key and must return the keys plus its new columns.
    """
    done = fn(df.select(*keys).distinct())
    return keyed_join(df, done, keys, "left", null_match=True)


def pending(wanted: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """The wanted keys that are not finished; ``force`` asks for all of them again."""
    return wanted if force else wanted.join(done.select(*keys), keys, "left_anti")


def available(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The wanted keys that exist."""
    return wanted.join(done.select(*keys), keys, "left_semi")


def cell_days(cells: DataFrame, days: DataFrame) -> DataFrame:
    """C4: every cell with every calendar day.

    The day table is a calendar (a century has 36,525 rows), so it is the broadcast side.
    """
    return cells.crossJoin(F.broadcast(days))
