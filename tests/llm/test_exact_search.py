"""Exact search against plain sums over all rows."""

import numpy as np
from pyspark.sql import functions as F

from airgrid.llm.exact_search import best_products, largest_products

VECTORS = "vec_id long, embedding array<float>, label int"


def floors(vector):
    return [int(np.floor(1024 * float(np.float32(x)))) for x in vector]


def expected(rows, asked, k):
    """rows: distinct (id, vector); the same sums with whole numbers of any size."""
    whole = [(i, floors(v)) for i, v in rows]
    out = []
    for i, q in whole:
        if asked(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in whole if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(table, every, **options):
    result = largest_products(table, F.col("vec_id") % every == 0, **options)
    assert result.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in result.collect())


def test_equals_brute_force_with_copies_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)]  # a large group of copies
    rows += [(2000 + i, [0.25] * 12) for i in range(10)] + [(3000, []), (3001, [0.5] * 3), (3002, [0.0] * 12)]
    bad = [(4000, None), (4010, [float("nan")] * 12), (4020, [float("inf")] * 12), (4030, [1.0, None]), (None, [1.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows + bad + rows[:20]], VECTORS)
    clashing = table.withColumns({c: F.lit("x") for c in ("row", "shard", "vector", "asked", "bar", "rank", "score")})
    want = expected(rows, lambda i: i % 10 == 0, 10)
    assert found(clashing.repartition(5), 10, shard_rows=64, query_rows=20, block=5, first_share=3) == want
    assert found(table, 10) == want
    assert found(table, 10, k=500, shard_rows=100) == expected(rows, lambda i: i % 10 == 0, 500)


def test_few_rows_none_and_an_id_with_two_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [0.5, -1.0], 1), (1, [2.0, 0.0], 1)], VECTORS)
    both = [(0, 1, 1, 2097152), (0, 2, 1, -1572864)]
    assert found(table, 2) == both
    assert found(table.limit(0), 2) == []
    assert found(table.limit(1), 2) == []
    twice = largest_products(table, F.col("vec_id") == 1).collect()
    assert sorted(r.score for r in twice) == [-1572864, 2097152]


def test_numbers_beyond_exact_doubles(spark):
    rows = [(0, [3e4, 1.0]), (1, [3e6, 2.0]), (2, [-1e30, 0.0]), (3, [1e30, 1e30]), (4, [7e6, -1e3])]
    table = spark.createDataFrame([(*r, 1) for r in rows], VECTORS)
    got = {r[2]: r[3] for r in found(table, 5)}
    whole = {i: floors(v) for i, v in rows}
    exact = {i: sum(a * b for a, b in zip(whole[0], v, strict=True)) for i, v in whole.items() if i}
    assert got == {i: min(max(s, -(1 << 63)), (1 << 63) - 1) for i, s in exact.items()}


def test_bounds_only_drop_what_cannot_reach_the_bar():
    rng = np.random.default_rng(6)
    for width in (1, 7, 64):
        rows = np.floor(rng.normal(size=(3000, width)) * 30)
        queries = np.floor(rng.normal(size=(20, width)) * 30)
        ids = rng.permutation(3000)
        bars = np.full(20, -np.inf)
        got = best_products(queries, np.full(20, -1), bars, rows, ids, 10, block=8, step=500)
        for (near, scores), query in zip(got, queries, strict=True):
            every = rows @ query
            top = np.lexsort((ids, -every))[:10]
            assert near.tolist() == ids[top].tolist() and scores.tolist() == every[top].tolist()
