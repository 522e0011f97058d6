"""Approximate nearest neighbours by cosine over shifted space-filling curves.

Vectors are projected to a few random directions, shifted at random, cut to a grid and ordered by
their place on a Hilbert curve; this is done several times with other directions and shifts. Near
vectors are near on at least some curve. Each curve is one range-partitioned order in Spark; a
query compares itself with all vectors whose place is within a window around its own, and the
nearest of all curves are merged. Cosines are computed on the original vectors.

Equal vectors are one point on every curve, so a large group of copies cannot fill the windows; of
each group only the smallest ids can be among the nearest, and exactly those are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .tables import cut_lineage


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of grid cells (rows) with `bits` bits per coordinate.

    Coordinates become the curve's transposed index by undoing, bit by bit from the top, the
    exchanges and reflections of the sub-cubes, followed by a Gray code; dims * bits must be < 64.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    bit = one << np.uint64(bits - 1)
    while bit > 1:
        below = bit - one
        for i in range(dims):
            turned = (x[i] & bit) > 0
            swapped = (x[0] ^ x[i]) & below
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swapped)
            if i:
                x[i] = np.where(turned, x[i], x[i] ^ swapped)
        bit >>= one
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = one << np.uint64(bits - 1)
    while bit > 1:
        flip = np.where((x[dims - 1] & bit) > 0, flip ^ (bit - one), flip)
        bit >>= one
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << one) | ((x[i] >> np.uint64(b)) & one)
    return place.astype(np.int64)


def _directions(dimension: int, curves: int, dims: int, seed: int) -> np.ndarray:
    """curves * dims random directions, orthogonal inside each curve where there are enough."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(curves):
        drawn = rng.normal(size=(dimension, dims))
        out.append(np.linalg.qr(drawn)[0] if dims <= dimension else drawn)
    return np.hstack(out)


def usable_vectors(table: DataFrame, is_query: Column) -> DataFrame:
    """vec_id, vector (doubles) and asked of the rows that can take part: those with an id and a
    vector that is not null or empty and whose components are all finite and not all zero."""
    vector = F.col("embedding").cast("array<double>")
    rows = table.select("vec_id", vector.alias("vector"), is_query.alias("asked"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return rows.where(
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & finite
        & F.exists("vector", lambda x: x != 0)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def curve_positions(points: DataFrame, curves: int, dims: int, bits: int, seed: int) -> DataFrame:
    """points(point, vector, ...) on every curve: all columns, curve, and pos, gapless per curve."""
    first = points.select("vector").first()
    if first is None:
        return points.select("*", F.lit(0).alias("curve"), F.lit(0).cast("long").alias("pos"))
    dimension = len(first["vector"])
    directions = _directions(dimension, curves, dims, seed)
    shifts = np.random.default_rng(seed + 1).uniform(size=curves * dims)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, directions.shape[1]))
        count = 0
        for batch in batches:
            x = _matrix(batch.column(0))
            y = x / np.linalg.norm(x, axis=1, keepdims=True) @ directions
            total += np.stack([y.sum(0), (y**2).sum(0)])
            count += len(y)
        yield pa.RecordBatch.from_arrays(
            [pa.array([count]), pa.array([total[0].tolist()]), pa.array([total[1].tolist()])],
            ["n", "sums", "squares"],
        )

    rows = points.select("vector").mapInArrow(
        moments, "n long, sums array<double>, squares array<double>"
    )
    each = rows.select("n", F.posexplode(F.arrays_zip("sums", "squares")).alias("i", "v"))
    spread = each.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("v.sums").alias("s"), F.sum("v.squares").alias("q")
    )
    got = sorted(spread.collect())  # one row per projected coordinate
    mean = np.array([r["s"] / r["n"] for r in got])
    deviation = np.sqrt(np.maximum([r["q"] / r["n"] for r in got] - mean**2, 1e-18))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        for batch in batches:
            names = batch.schema.names
            x = _matrix(batch.column(names.index("vector")))
            y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ directions
            # Three standard deviations to both sides fill half of the grid, the shift the rest.
            unit = (np.clip((y - mean) / deviation, -3, 3) / 6 + 0.5 + shifts) / 2
            cells = np.minimum((unit * (1 << bits)).astype(np.int64), (1 << bits) - 1)
            keys = np.stack(
                [
                    hilbert_index(cells[:, c * dims : (c + 1) * dims], bits)
                    for c in range(curves)
                ],
                axis=1,
            )
            offsets = np.arange(0, keys.size + 1, curves)
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*names, "keys"])

    schema = points.select("*").schema.add("keys", ArrayType(LongType()))
    keyed = points.mapInArrow(place, schema)
    dealt = keyed.select(*points.columns, F.posexplode("keys").alias("curve", "key"))
    parts = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # Written once: the numbers below belong to exactly these rows in exactly this order.
    laid = cut_lineage(
        dealt.repartitionByRange(parts, "curve", "key", F.xxhash64("point"), "point")
        .sortWithinPartitions("curve", "key", F.xxhash64("point"), "point")
        .drop("key")
        .withColumn("at", F.monotonically_increasing_id())
    )
    part = F.shiftright("at", 33)
    sizes = laid.groupBy("curve", part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("low")
    )
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "curve", "part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    # One row per curve and partition.
    return (
        laid.withColumn("part", part)
        .join(F.broadcast(starts), ["curve", "part"])
        .withColumn("pos", F.col("start") + F.col("at") - F.col("low"))
        .drop("at", "part", "low", "start")
    )


def _window_matches(placed: DataFrame, k: int, window: int, block: int) -> DataFrame:
    """query_point, near_point, score: on every curve, the best k + 1 points around each query.

    Every curve is cut into blocks of `block` places. Points go to their own block, queries also to
    the neighbouring blocks that their window reaches, so a task holds one block at a time.
    """
    home = F.floor(F.col("pos") / block).cast("long")
    data = placed.select(
        "curve", home.alias("block"), "pos", "point", "vector", F.lit(False).alias("query")
    )
    low = F.floor(F.greatest(F.col("pos") - window, F.lit(0)) / block).cast("long")
    high = F.floor((F.col("pos") + window) / block).cast("long")
    queries = placed.where("asked").select(
        "curve",
        F.explode(F.sequence(low, high)).alias("block"),
        "pos",
        "point",
        "vector",
        F.lit(True).alias("query"),
    )

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["query"].to_numpy()
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_point": [], "near_point": [], "score": []})
        vectors = np.stack(rows["vector"].to_numpy())
        vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        pos, point = rows["pos"].to_numpy(), rows["point"].to_numpy()
        d_pos, d_point, d_vectors = pos[~asks], point[~asks], vectors[~asks]
        out = []
        for at in range(0, int(asks.sum()), 256):
            q_pos, q_point, q_vectors = (x[asks][at : at + 256] for x in (pos, point, vectors))
            scores = q_vectors @ d_vectors.T
            near = np.abs(q_pos[:, None] - d_pos[None, :]) <= window
            scores[~near | (q_point[:, None] == d_point[None, :])] = -np.inf
            top = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
            best = np.take_along_axis(scores, top, 1)
            q, c = np.nonzero(np.isfinite(best))
            out.append(
                pd.DataFrame(
                    {
                        "query_point": q_point[q],
                        "near_point": d_point[top[q, c]],
                        "score": best[q, c],
                    }
                )
            )
        return pd.concat(out)

    return data.union(queries).groupBy("curve", "block").applyInPandas(
        match, "query_point long, near_point long, score double"
    )


def _cosine(x: str, y: str) -> Column:
    def dot(a: str, b: str) -> Column:
        products = F.zip_with(a, b, lambda p, q: p * q)
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    return dot(x, y) / F.sqrt(dot(x, x)) / F.sqrt(dot(y, y))


def nearest_vectors(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    curves: int = 24,
    dims: int = 5,
    bits: int = 10,
    window_share: float = 0.02,
    least_window: int = 500,
    block: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """For every row where `is_query` holds: query_id, rank, vec_id, score of the k nearest found.

    The window to either side of a query holds `window_share` of the distinct vectors, at least
    `least_window`. score is the cosine of the original vectors in double precision; ties go to the
    smaller vec_id. A query never finds its own id. Null, empty, zero or non-finite vectors, null
    ids and vectors of another length than the usable row with the least id has take no part. Rows
    repeated in id and vector count once. Fewer than k rows come back where fewer vectors exist.
    """
    usable = usable_vectors(table, is_query).distinct()
    length = usable.agg(F.min_by(F.size("vector"), "vec_id")).first()[0]
    usable = usable.where(F.size("vector") == F.lit(length))
    points = cut_lineage(
        usable.groupBy("vector").agg(F.min("vec_id").alias("point"), F.max("asked").alias("asked"))
    )
    members = cut_lineage(
        usable.join(points.select("vector", "point"), "vector").select("vec_id", "point", "asked")
    )
    window = max(least_window, math.ceil(window_share * points.count()))
    placed = curve_positions(points, curves, dims, bits, seed)
    best = Window.partitionBy("query_point").orderBy(F.desc("score"), "near_point")
    found = (
        _window_matches(placed, k, window, block)
        .groupBy("query_point", "near_point")
        .agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)
        .select("query_point", "near_point")
    )
    # The query's own point is near too: its copies are other rows with the same vector.
    asked = points.where("asked")
    found = found.union(asked.select(F.col("point"), F.col("point")))
    scored = (
        found.join(points.select(F.col("point").alias("query_point"), F.col("vector").alias("x")), "query_point")
        .join(points.select(F.col("point").alias("near_point"), F.col("vector").alias("y")), "near_point")
        .select("query_point", "near_point", _cosine("x", "y").alias("score"))
    )
    # The k + 1 smallest ids of a point: no other can be among the k nearest of any query.
    by_id = Window.partitionBy("point").orderBy("vec_id")
    smallest = (
        members.select("point", "vec_id")
        .distinct()
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= k + 1)
        .select(F.col("point").alias("near_point"), "vec_id")
    )
    nearest = Window.partitionBy("query_point").orderBy(F.desc("score"), "vec_id")
    per_point = (
        scored.join(smallest, "near_point")
        .withColumn("place", F.row_number().over(nearest))
        .where(F.col("place") <= k + 1)
    )
    queries = members.where("asked").select(
        F.col("vec_id").alias("query_id"), F.col("point").alias("query_point")
    )
    final = Window.partitionBy("query_id", "query_point").orderBy(F.desc("score"), "vec_id")
    return (
        queries.join(per_point.drop("place"), "query_point")
        .where(F.col("query_id") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
