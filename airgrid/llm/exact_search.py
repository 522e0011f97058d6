"""Exact search for the largest inner products: columnar branch and bound.

Rows are dealt into shards. In a shard the vectors lie in vertical layout, one line per component,
and the components are cut into blocks. A query reads block after block, the ones that hold most of
its own mass first, and adds up the products of the candidates that are left. What the unread
blocks can still add is at most the product of both sides' masses there (root of the sum of
squares, block by block), so a candidate whose sum and remaining mass stay under the k-th best
score is dropped and the rest moves together. Nothing else is dropped: the result is exact.

A small share of the shards is searched first. The k-th best score of each query there is the bar
for all other shards, so a shard hands over few rows, however many shards there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut_lineage

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole_numbers(vectors: pa.ChunkedArray, scale: float) -> np.ndarray:
    """One row per vector, floor(scale * x) in double precision; shorter vectors end in zeros."""
    column = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    longest = int(lengths.max(initial=0))
    if lengths.size and (lengths == longest).all():
        return np.floor(scale * flat).reshape(len(lengths), longest)
    out = np.zeros((len(lengths), longest))
    out[np.arange(longest) < lengths[:, None]] = np.floor(scale * flat)
    return out


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def best_products(
    queries: np.ndarray,
    query_ids: np.ndarray,
    bars: np.ndarray,
    rows: np.ndarray,
    row_ids: np.ndarray,
    k: int,
    block: int = 8,
    step: int = 8192,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of each query's k best rows with another id and a score not under its bar.

    Larger scores come first, then smaller ids. All numbers must be whole.
    """
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = _widened(queries, width), _widened(rows, width)
    largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * width
    if not largest < 2.0**45:
        return _best_of_large(queries, query_ids, bars, rows, row_ids, k)
    # Rows of large mass first: they are the likeliest to lift the bar early.
    first = np.argsort(-np.square(rows).sum(1), kind="stable")
    ids, upright = row_ids[first], np.ascontiguousarray(rows[first].T)
    cuts = [slice(at, min(at + block, width)) for at in range(0, width, block)]
    row_mass = np.stack([np.sqrt(np.square(upright[c]).sum(0)) for c in cuts] or [np.zeros(len(ids))])
    query_mass = np.stack(
        [np.sqrt(np.square(queries[:, c]).sum(1)) for c in cuts] or [np.zeros(len(queries))], axis=1
    )
    out = []
    for query, own, bar, mass in zip(queries, query_ids, bars, query_mass, strict=True):
        best_ids, best = np.empty(0, ids.dtype), np.empty(0)
        order = np.argsort(-mass, kind="stable")[: len(cuts)]
        for at in range(0, len(ids), step):
            # The most that each row can still reach; rounding stays far under one half.
            reach = mass @ row_mass[:, at : at + step]
            alive = at + np.flatnonzero((reach >= bar - 0.5) & (ids[at : at + step] != own))
            reach, score = reach[alive - at], np.zeros(len(alive))
            for b in order:
                if not alive.size:
                    break
                gained = query[cuts[b]] @ upright[cuts[b]][:, alive]
                score += gained
                reach += gained - mass[b] * row_mass[b, alive]
                left = reach >= bar - 0.5
                if not left.all():
                    alive, reach, score = alive[left], reach[left], score[left]
            enough = score >= bar
            best_ids = np.concatenate([best_ids, ids[alive[enough]]])
            best = np.concatenate([best, score[enough]])
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
            if len(best) == k:
                bar = max(bar, best[-1])
        out.append((best_ids, best.astype(np.int64)))
    return out


def _best_of_large(queries, query_ids, bars, rows, row_ids, k):
    """The same with numbers too large for exact doubles: whole numbers of any size, no bound."""
    whole = [[int(x) for x in row] for row in rows]
    out = []
    for query, own, bar in zip(queries, query_ids, bars, strict=True):
        asked = [int(x) for x in query]
        scored = [
            (-min(max(sum(map(int.__mul__, asked, row)), LEAST), MOST), int(i))
            for row, i in zip(whole, row_ids, strict=True)
            if i != own
        ]
        top = [x for x in sorted(scored)[:k] if -x[0] >= bar]
        out.append(
            (np.array([i for _, i in top], np.int64), np.array([-s for s, _ in top], np.int64))
        )
    return out


def _search(scale: float, k: int, block: int) -> Callable[[pa.Table], pa.Table]:
    def search(cell: pa.Table) -> pa.Table:
        asked = cell.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        data, queries = cell.filter(pa.array(~asked)), cell.filter(pa.array(asked))
        found = best_products(
            whole_numbers(queries.column("vector"), scale),
            queries.column("vec_id").to_numpy(),
            queries.column("bar").to_numpy().astype(np.float64),
            whole_numbers(data.column("vector"), scale),
            data.column("vec_id").to_numpy(),
            k,
            block,
        )
        counts = [len(ids) for ids, _ in found]
        rows = np.repeat(queries.column("row").to_numpy(), counts)
        near = np.concatenate([np.empty(0, np.int64), *(ids for ids, _ in found)])
        scores = np.concatenate([np.empty(0, np.int64), *(s for _, s in found)])
        columns = [pa.array(x, pa.int64()) for x in (rows, near, scores)]
        return pa.Table.from_arrays(columns, ["row", "near_id", "score"])

    return search


def largest_products(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: float = 1024.0,
    shard_rows: int = 8192,
    query_rows: int = 16384,
    block: int = 8,
    first_share: int = 64,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k largest inner products of floor(scale * x).

    Every row where `is_query` holds is compared with every row of another vec_id; equal scores go
    to the smaller vec_id. Fewer than k rows come back where fewer rows exist.

    Null vectors, vectors with null or non-finite components and rows with a null id take no part.
    An empty vector takes part with score 0, and a shorter vector counts as ending in zeros. Rows
    repeated in id and vector count once; an id with several vectors asks once for each of them.
    Other columns are left out, whatever their names. Scores beyond 64 bits are held at its ends.

    A task holds `shard_rows` rows and `query_rows` queries. Rows are copied once for each
    `query_rows` queries, queries once for each shard. One shard in `first_share`, at least one,
    is searched first, to set the bars of the others.
    """
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    usable = (
        table.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asked"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite)
        .distinct()
    )
    # Written once: row numbers stay with their rows.
    rows = cut_lineage(usable.withColumn("row", F.monotonically_increasing_id()))
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    shards = max(1, math.ceil(total / shard_rows))
    groups = max(1, math.ceil(asking / query_rows))
    opening = math.ceil(shards / first_share)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    data = dealt.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"),
        "row",
        "vec_id",
        "vector",
        F.lit(False).alias("asked"),
        F.lit(LEAST).alias("bar"),
    )
    queries = dealt.where("asked").select(
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int").alias("part"),
        "row",
        "vec_id",
        "vector",
        "asked",
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), "near_id")

    def search(low: int, high: int, asked: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("shard")
        both = data.where(F.col("shard").between(low, high - 1)).unionByName(
            asked.select(every, "part", "row", "vec_id", "vector", "asked", "bar")
        )
        return (
            both.groupBy("shard", "part")
            .applyInArrow(_search(scale, k, block), "row long, near_id long, score long")
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
        )

    found = search(0, opening, queries.withColumn("bar", F.lit(LEAST)))
    if opening < shards:
        found = cut_lineage(found)
        bars = found.where(F.col("rank") == k).select("row", F.col("score").alias("bar"))
        barred = queries.join(bars, "row", "left").withColumn(
            "bar", F.coalesce("bar", F.lit(LEAST))
        )
        found = (
            found.unionByName(search(opening, shards, barred))
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
        )
    asked = rows.where("asked").select("row", F.col("vec_id").alias("query_id"))
    return asked.join(found, "row").select(
        "query_id", "rank", F.col("near_id").alias("vec_id"), "score"
    )
