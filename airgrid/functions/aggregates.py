"""Aggregate expressions that follow the missing-value rules of the models.

All of them are built from fixed-size built-in aggregates, so they combine before a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import nan_to_null


def strict_mean(value: Column) -> Column:
    """Mean that is NULL as soon as one value of the group is NULL or NaN."""
    value = nan_to_null(value)
    return F.when(F.count(value) == F.count(F.lit(1)), F.avg(value))


def strict_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one value of the group is NULL or NaN."""
    value = nan_to_null(value)
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Weighted mean over present values; a group without any gives NULL."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def missing_count(value: Column) -> Column:
    """Number of NULLs."""
    return F.count_if(value.isNull())


def r_squared(observed: Column, predicted: Column) -> Column:
    """Squared correlation over complete pairs; NULL when either side is constant."""
    both = observed.isNotNull() & predicted.isNotNull()
    o, p = F.when(both, observed), F.when(both, predicted)
    correlation = F.try_divide(F.covar_pop(o, p), F.stddev_pop(o) * F.stddev_pop(p))
    return correlation * correlation


def origin_slope(x: Column, y: Column) -> Column:
    """Least-squares slope of ``y`` on ``x`` through the origin, over complete pairs."""
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.sum(F.when(both, x * y)), F.sum(F.when(both, x * x)))
