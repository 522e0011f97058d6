"""Exact quantiles of groups of any size.

The built-in exact ``percentile`` keeps all distinct values of a group in one task's memory. That is
right for groups bounded by the calendar, and wrong for groups such as "all out-of-bag rows". Here
equal values collapse first. A group with few distinct values is ordered as it is. A larger one is
narrowed: a fixed-size sketch cuts it into bins, the bins are counted, the ones that hold a wanted
rank are kept and cut again, until each has few enough distinct values to be ordered. The sketch
decides where the cuts lie, never the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .grid import pin
from .joins import keyed_join

CUTS = 32
MOST_ORDERED = 200_000
MOST_BROADCAST = 100_000


def exact_quantiles(
    df: DataFrame, by: list[str], cols: list[str], probs: list[float], bound: int = MOST_ORDERED
) -> DataFrame:
    """One row per (group, measure) with ``n`` (BIGINT) and ``q0..`` (linear interpolation).

    ``measure`` is the column name. NULL and NaN values are left out; a group without any value has
    no row. No task orders more than ``bound`` distinct values of a group. The distinct values are
    written once, so that what lies above runs once; how many rounds of narrowing there are depends
    on the largest group (none up to ``bound`` values, one up to about 32 times that, ...).
    """
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    long = df.select(*by, F.expr(f"stack({len(cols)}, {pairs}) as (measure, _v)")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    keys = [*by, "measure"]
    # Equal values collapse to one weighted row before anything is ranked, so ties cost nothing.
    weighted = cut_lineage(long.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w")))
    sizes = weighted.groupBy(*keys).agg(F.sum("_w").alias("n"), F.count(F.lit(1)).alias("_d"))
    large = sizes.where(F.col("_d") > bound)
    many = large.count()
    small = weighted
    if many:
        large = _small_side(cut_lineage(large.drop("_d")), many)
        small = keyed_join(weighted, large.select(*keys), keys, "left_anti", null_match=True)
    group = Window.partitionBy(*keys)
    ordered = _with_ranks(
        small.withColumns({"n": F.sum("_w").over(group), "_base": F.lit(0).cast("long")}), keys
    )
    hits = ordered.where(_any_rank(probs, F.col("_first"), F.col("_last")))
    if many:
        narrowed = narrowed_groups(weighted, large, keys, probs, bound)
        inside = _with_ranks(narrowed, [*keys, "_part"]).drop("_part")
        inside = inside.where(_any_rank(probs, F.col("_first"), F.col("_last")))
        hits = hits.unionByName(inside)
    picks = [F.max("n").alias("n")]
    for i, p in enumerate(probs):
        for end, rank in zip(("lo", "hi"), _ranks(p), strict=True):
            hit = (rank >= F.col("_first")) & (rank < F.col("_last"))
            picks.append(F.max(F.when(hit, F.col("_v"))).alias(f"_v{end}{i}"))
    result = hits.groupBy(*keys).agg(*picks)
    quantiles = []
    for i, p in enumerate(probs):
        low, high, position = F.col(f"_vlo{i}"), F.col(f"_vhi{i}"), (F.col("n") - 1) * F.lit(float(p))
        between = low + (position - F.floor(position)) * (high - low)
        quantiles.append(F.when(low == high, low).otherwise(between).alias(f"q{i}"))
    return result.select(*keys, "n", *quantiles)


def _ranks(p: float) -> tuple[Column, Column]:
    """The two ranks, from 0, between which a quantile of ``n`` values lies."""
    position = (F.col("n") - 1) * F.lit(float(p))
    return F.floor(position), F.ceil(position)


def _any_rank(probs: list[float], first: Column, after: Column) -> Column:
    wanted = F.lit(False)
    for p in probs:
        for rank in _ranks(p):
            wanted = wanted | ((rank >= first) & (rank < after))
    return wanted


def _with_ranks(rows: DataFrame, part: list[str]) -> DataFrame:
    """``_first`` and ``_last``: the ranks of a value's first copy, and the one after its last."""
    upto = Window.partitionBy(*part).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last = F.col("_base") + F.sum("_w").over(upto)
    return rows.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_w"))


def _small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast what has been counted to be small; anything else is joined by shuffle."""
    return F.broadcast(df) if rows <= MOST_BROADCAST else df


def narrowed_groups(
    weighted: DataFrame, large: DataFrame, keys: list[str], probs: list[float], bound: int
) -> DataFrame:
    """``(keys, n, _part, _base, _v, _w)``: of the groups in ``large(keys, n)`` only values around the
    wanted ranks, in parts of at most ``bound`` distinct values. ``_base`` is the rank at which a
    part begins.

    Each round reads only what the last one kept; with 32 bins and few ranks that is a small share.
    """
    rows = keyed_join(weighted, large, keys, "inner", null_match=True).withColumns(
        {"_part": F.lit(0).cast("long"), "_base": F.lit(0).cast("long")}
    )
    part = [*keys, "_part"]
    grid = [i / CUTS for i in range(1, CUTS)]
    while True:
        cuts = cut_lineage(
            rows.groupBy(*part).agg(
                F.percentile_approx("_v", grid, 4096).alias("_cuts"), F.count(F.lit(1)).alias("_d")
            )
        )
        # Parts that fit already are one bin.
        cuts = cuts.withColumn("_cuts", F.when(F.col("_d") > bound, F.col("_cuts")))
        parts, most = cuts.agg(F.count(F.lit(1)), F.max("_d")).first()
        if most <= bound:
            return rows
        above = [
            F.coalesce((F.get("_cuts", F.lit(i)) < F.col("_v")).cast("int"), F.lit(0))
            for i in range(CUTS - 1)
        ]
        tagged = keyed_join(rows, _small_side(cuts.drop("_d"), parts), part, "inner", null_match=True)
        tagged = pin(tagged, "_bin", sum(above[1:], above[0])).drop("_cuts")
        bins = tagged.groupBy(*part, "n", "_base", "_bin").agg(F.sum("_w").alias("_bw"))
        below = Window.partitionBy(*part).orderBy("_bin").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        bins = bins.withColumn("_start", F.col("_base") + F.sum("_bw").over(below) - F.col("_bw"))
        wanted = cut_lineage(
            bins.where(_any_rank(probs, F.col("_start"), F.col("_start") + F.col("_bw"))).select(
                *part, "_bin", "_start"
            )
        )
        kept = keyed_join(
            tagged, _small_side(wanted, 2 * len(probs) * parts), [*part, "_bin"], "inner", null_match=True
        )
        rows = cut_lineage(
            kept.select(
                *keys,
                "n",
                (F.col("_part") * CUTS + F.col("_bin")).alias("_part"),
                F.col("_start").alias("_base"),
                "_v",
                "_w",
            )
        )


def medians(df: DataFrame, by: list[str], cols: list[str], prefix: str = "") -> DataFrame:
    """Exact median of several measures per group, one row per group."""
    long = exact_quantiles(df, by, cols, [0.5])
    wide = long.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("measure") == c, F.col("q0"))).alias(f"{prefix}{c}")
            for c in cols
        ]
    )
    return wide


def profile(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """N, min, quartiles, mean, max and sample variance of one measure per group."""
    clean = F.when(~F.isnan(col), F.col(col))
    moments = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(clean).alias("min"),
        F.avg(clean).alias("mean"),
        F.max(clean).alias("max"),
        F.var_samp(clean).alias("variance"),
    )
    order = exact_quantiles(df, by, [col], [0.25, 0.5, 0.75]).select(
        *by,
        F.col("q0").alias("q25"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q75"),
    )
    if not by:
        return moments.join(F.broadcast(order), how="left")
    return keyed_join(moments, order, by, "left", null_match=True)


def box_stats(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier count per group."""
    order = exact_quantiles(df, by, [col], [0.25, 0.5, 0.75]).select(
        *by,
        F.col("q0").alias("q25"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q75"),
        F.col("n"),
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    value = F.col(col).cast("double")
    inside = value.between(F.col("q25") - reach, F.col("q75") + reach)
    return (
        keyed_join(df.select(*by, col), order, by, "inner", null_match=True)
        .where(F.col(col).isNotNull() & ~F.isnan(col))
        .groupBy(*by)
        .agg(
            F.max("n").alias("n"),
            F.max("q25").alias("q25"),
            F.max("median").alias("median"),
            F.max("q75").alias("q75"),
            F.min(F.when(inside, value)).alias("low_whisker"),
            F.max(F.when(inside, value)).alias("high_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )
