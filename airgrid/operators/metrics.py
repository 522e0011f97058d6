"""Accuracy of predictions at several time and space resolutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.aggregates import origin_slope, r_squared, strict_mean
from ..functions.calendar import week_block
from ..functions.scalars import Z95
from . import grid
from .joins import keyed_join
from .quantiles import exact_quantiles, medians

# The five time levels in report order.
TIME_LEVELS = ("all", "annual", "monthly", "weekly", "daily")

CELL_MEASURES = [
    "n_time_units",
    "n_observations",
    "median_ae",
    "rmse",
    "rsq",
    "slope",
    "ci_coverage",
]


def stack_predictions(df: DataFrame, keep: list[str]) -> DataFrame:
    """In-bag and out-of-bag columns to rows ``(oob, pred, se)``."""
    return df.select(
        *keep,
        F.expr(
            "stack(2, 'oob', pred_oob, se_oob, 'inbag', pred_inbag, se_inbag) as (oob, pred, se)"
        ),
    )


def add_interval(
    df: DataFrame,
    observed: str = "pm25",
    predicted: str = "pred",
    error: str = "se",
    inclusive: bool = False,
) -> DataFrame:
    """95 % interval, its length and whether it covers the observation."""
    low = F.col(predicted) - F.col(error) * Z95
    high = F.col(predicted) + F.col(error) * Z95
    o = F.col(observed)
    covered = ((o <= high) & (o >= low)) if inclusive else ((o < high) & (o > low))
    return df.withColumns(
        {"lci": low, "uci": high, "ci_length": high - low, "ci_covered": covered}
    )


def _moments(o: Column, p: Column, covered: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sqrt(strict_mean((o - p) * (o - p))).alias("rmse"),
        r_squared(o, p).alias("rsq"),
        origin_slope(o, p).alias("slope"),
        (strict_mean(covered.cast("double")) * 100).alias("ci_coverage"),
    ]


def accuracy_metrics(
    df: DataFrame,
    by: list[str],
    observed: str = "pm25",
    predicted: str = "pred",
    covered: str = "ci_covered",
    slope_scope: str = "group",
) -> DataFrame:
    """N, median absolute error, RMSE, R², slope through the origin, interval coverage.

    Groups may be of any size: the median comes from :func:`exact_quantiles`. A group with a
    missing error has no median and no RMSE. ``slope_scope="global"`` gives every group the slope of
    the whole table. The median is reported as ``median_ae`` and, under its report name, ``mae``.
    """
    o, p = F.col(observed), F.col(predicted)
    moments = df.groupBy(*by).agg(*_moments(o, p, F.col(covered)))
    error = df.withColumn("_ae", F.abs(o - p))
    middle = (
        exact_quantiles(error, by, ["_ae"], [0.5])
        .withColumnRenamed("n", "_present")
        .select(*by, F.col("q0").alias("_q"), "_present")
    )
    out = keyed_join(moments, middle, by, "left", null_match=True)
    whole = F.when(F.col("_present") == F.col("n"), F.col("_q"))
    out = out.withColumns({"median_ae": whole, "mae": whole}).drop("_q", "_present")
    if slope_scope == "global":
        overall = df.agg(origin_slope(o, p).alias("slope"))
        out = out.drop("slope").crossJoin(F.broadcast(overall))
    return out


def temporal_rollup(
    df: DataFrame,
    cell: str = "cell",
    date: str = "date",
    observed: str = "pm25",
    predicted: str = "pred",
    error: str = "se",
) -> DataFrame:
    """Count, mean observation, mean prediction and sqrt(sum se²) per cell at five time levels.

    Rows are first reduced to cell-days; the coarser levels are built from those partial sums, so
    raw rows are shuffled once (after combining) whatever the number of levels. A mean with a missing
    member is missing.
    """
    day = df.groupBy(cell, "oob", date).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(observed).alias("_no"),
        F.count(predicted).alias("_np"),
        F.count(error).alias("_ne"),
        F.sum(observed).alias("_so"),
        F.sum(predicted).alias("_sp"),
        F.sum(F.col(error) * F.col(error)).alias("_se"),
    )
    year, d = F.year(date), F.col(date)
    no_year, no_number = F.lit(None).cast("int"), F.lit(None).cast("int")
    levels = F.array(
        _level("all", 0, no_year, no_number, d, False),
        _level("annual", 1, year, no_number, d, False),
        _level("monthly", 2, year, F.month(date), d, False),
        _level("weekly", 3, year, week_block(d), d, False),
        _level("daily", 4, year, no_number, d, True),
    )
    sums = (
        day.withColumn("_l", F.explode(levels))
        .select(cell, "oob", "_l.*", *[f"_{c}" for c in ("n", "no", "np", "ne", "so", "sp", "se")])
        .groupBy(cell, "oob", "time", "time_rank", "year", "unit", "day")
        .agg(*[F.sum(f"_{c}").alias(f"_{c}") for c in ("n", "no", "np", "ne", "so", "sp", "se")])
    )
    n = F.col("_n")
    return sums.select(
        cell,
        "oob",
        "time",
        "time_rank",
        "year",
        "unit",
        "day",
        n.alias("n"),
        F.when(F.col("_no") == n, F.col("_so") / n).alias("mean_pm25"),
        F.when(F.col("_np") == n, F.col("_sp") / n).alias("mean_pred"),
        F.when(F.col("_ne") == n, F.sqrt("_se")).alias("mean_se"),
    )


def _level(name: str, rank: int, year: Column, unit: Column, day: Column, daily: bool) -> Column:
    return F.struct(
        F.lit(name).alias("time"),
        F.lit(rank).alias("time_rank"),
        year.cast("int").alias("year"),
        unit.cast("int").alias("unit"),
        (day if daily else F.lit(None).cast("date")).alias("day"),
    )


def cell_errors(
    rollup: DataFrame, cell: str = "cell", se_of_mean: bool = False, slope_scope: str = "group"
) -> DataFrame:
    """Accuracy per (time level, cell, oob) over that level's time units.

    The interval is inclusive at this level. ``se_of_mean`` divides the combined error by n first.
    A group is one cell's time units, whose number is bounded by the calendar.
    """
    se = F.col("mean_se") / F.col("n") if se_of_mean else F.col("mean_se")
    units = add_interval(
        rollup.withColumn("mean_se", se), "mean_pm25", "mean_pred", "mean_se", inclusive=True
    )
    o, p = F.col("mean_pm25"), F.col("mean_pred")
    error = F.abs(o - p)
    out = units.groupBy("time", "time_rank", cell, "oob").agg(
        F.count(F.lit(1)).alias("n_time_units"),
        F.sum("n").alias("n_observations"),
        F.when(F.count(error) == F.count(F.lit(1)), F.median(error)).alias("median_ae"),
        *_moments(o, p, F.col("ci_covered"))[1:],
    )
    if slope_scope == "global":
        overall = units.groupBy("time").agg(origin_slope(o, p).alias("slope"))
        out = out.drop("slope").join(F.broadcast(overall), "time", "left")
    return out


def across_cells(errors: DataFrame) -> DataFrame:
    """Median over cells of every measure, per time level and prediction kind."""
    return medians(errors, ["time", "time_rank", "oob"], CELL_MEASURES, prefix="median_")


def coarse_cell_errors(
    errors: DataFrame, cell: str, from_res: int, to_res: int = 2
) -> DataFrame:
    """Median of every measure per coarse cell, time level and prediction kind."""
    coarse = grid.add_parent(errors, cell, from_res, to_res, "coarse")
    return medians(coarse, ["time", "time_rank", "coarse", "oob"], CELL_MEASURES)


def hexbin(
    df: DataFrame,
    x: str,
    y: str,
    width: float,
    limit: tuple[float, float],
    by: list[str] | None = None,
) -> DataFrame:
    """Counts on a hexagonal lattice of two measures; rows outside the limits are left out."""
    low, high = limit
    inside = df.where(F.col(x).between(low, high) & F.col(y).between(low, high))
    s = width / grid.ROOT3
    bin_q, bin_r = grid.axial_of(F.col(x), F.col(y), s)
    counts = (
        inside.withColumns({"bin_q": bin_q, "bin_r": bin_r})
        .groupBy(*(by or []), "bin_q", "bin_r")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    q, r = F.col("bin_q"), F.col("bin_r")
    return counts.withColumns(
        {
            "bin_x": (q * grid.ROOT3 + r * (grid.ROOT3 / 2)) * s,
            "bin_y": r * 1.5 * s,
        }
    )


def sample_rows(df: DataFrame, keys: list[str], n: int, seed: int = 224) -> DataFrame:
    """``n`` pseudo-random rows, the same ones every time (a top-n on a seeded hash)."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)
