"""Wide/long conversions and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def wide_by(df: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """One column per listed name. A repeated (key, name) raises when the result is computed."""
    alone = F.when(F.count(F.lit(1)) <= 1, F.first(value)).otherwise(
        F.raise_error(F.lit(f"more than one {value} for a key and {name}"))
    )
    checked = df.groupBy(*keys, name).agg(alone.cast("double").alias("_v"))
    return checked.groupBy(*keys).agg(
        *[F.max(F.when(F.col(name) == n, F.col("_v"))).alias(n) for n in names]
    )


def long_by_suffix(df: DataFrame, keys: list[str], prefix: str, name: str, value: str) -> DataFrame:
    """``prefix.suffix`` columns to rows; the suffix becomes a number."""
    wide = [c for c in df.columns if c.startswith(prefix + ".")]
    pairs = ", ".join(f"'{c}', `{c}`" for c in wide)
    long = df.select(*keys, F.expr(f"stack({len(wide)}, {pairs}) as (_name, {value})"))
    suffix = F.split("_name", "[.]").getItem(1).try_cast("int")
    return long.select(*keys, suffix.alias(name), value)


def stack_named(parts: dict[str, DataFrame], name: str) -> DataFrame:
    """I4/G1: several tables one below the other, with their name as a column."""
    tagged = [df.withColumn(name, F.lit(key)) for key, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def append(*parts: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of all tables by column name; ``strict`` wants equal columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), parts)
