import itertools
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from airgrid.llm.mixing import in_mixture_order, mix
from airgrid.llm.tables import read
from airgrid.llm.vector_search import hilbert_index, nearest_vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def test_hilbert_order_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        place = hilbert_index(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def cosine(a, b):
    a, b = (np.asarray(np.asarray(x, np.float32), np.float64) for x in (a, b))
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def check_nearest(table, rows, every, **options):
    got = {}
    for r in nearest_vectors(table, F.col("vec_id") % every == 0, **options).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for doc, vector in rows:
        if doc % every:
            continue
        found = [got[doc][i] for i in range(1, len(got.get(doc, {})) + 1)] if doc in got else []
        best = sorted((-cosine(vector, v), i) for i, v in rows if i != doc)[:5]
        assert np.allclose([s for _, s in found], [-s for s, _ in best], atol=1e-12)
        for (i, score), (want, _) in zip(found, best, strict=True):
            assert np.isclose(score, -want)
            assert np.isclose(cosine(vector, dict(rows)[i]), score, atol=1e-12)
        for (a, x), (b, y) in zip(found, found[1:], strict=False):
            assert x > y - 1e-12 and (a < b or not np.isclose(x, y, atol=1e-15) or x > y)
    assert set(got) <= {i for i, _ in rows if i % every == 0}


def test_whole_windows_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(100)]  # many copies of one vector
    bad = [(2000, None), (2010, []), (2020, [0.0] * 8), (2030, [float("nan")] * 8)]
    bad += [(2040, [1.0, None] * 4), (2050, [float("inf")] * 8), (None, rows[1][1]), (2060, [1.0] * 3)]
    table = spark.createDataFrame([(*r, 1) for r in rows + bad + rows[:5]], VECTORS)
    table = table.withColumns({"point": F.lit("x"), "pos": F.lit(1)}).repartition(5)
    check_nearest(table, rows, 10, curves=3, dims=3, least_window=600, block=64)


def test_recall_of_small_windows(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16)) * 2
    vectors = (centres[rng.integers(60, size=3000)] + rng.normal(size=(3000, 16))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], VECTORS)
    rows = nearest_vectors(table, F.col("vec_id") % 50 == 0, window_share=0.02, least_window=10).collect()
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        scores = unit @ unit[q]
        scores[q] = -2
        hits += len({r.vec_id for r in rows if r.query_id == q} & set(np.argsort(-scores)[:5].tolist()))
    assert len(rows) == 300 and hits >= 0.9 * 300


def test_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert nearest_vectors(empty, F.col("vec_id") % 50 == 0).count() == 0
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (3, [1.0, 0.5])]
    table = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    check_nearest(table, rows, 50)
    alone = spark.createDataFrame([(0, [1.0], 0)], VECTORS)
    assert nearest_vectors(alone, F.col("vec_id") == 0).count() == 0


def test_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    rng = random.Random(1)
    copies = docs.where("doc_id < 30").withColumn("doc_id", F.col("doc_id") + 10_000)
    docs = docs.union(copies).withColumn("label", F.lit(rng.randrange(9)))
    sizes, kept = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.cut_lineage(stage(spark, kept, sf))
        assert kept.columns == docs.columns, name
        sizes.append(kept.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] == sizes[4]
    before = {r.doc_id: r for r in docs.collect()}
    for r in kept.collect():
        old = before[r.doc_id]
        lines = set(r.text.split("\n")) if r.text else set()
        assert lines <= set(old.text.split("\n")) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (old.lang, old.source)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept.collect()}


def test_run_applies_every_stage(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() >= 100


def test_packing_follows_the_mixture(spark):
    rows = [(i, f"the text {i % 7} " + "of words " * (i % 90 * 9), "ab"[i % 5 == 0]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def packed(weights):
        mixed = mix(docs, weights, block_rows=1, law="weights")
        laid = corpus_pipeline.cut_lineage(in_mixture_order(mixed, 5).select(*docs.columns))
        got = corpus_pipeline.pack_sequences(spark, laid, "").collect()
        assert sorted({r.sequence_id for r in got}) == list(range(max(r.sequence_id for r in got) + 1))
        place = {r.doc_id: r.position for r in mixed.collect()}
        # Sequences come in the mixture's order of their first pieces.
        first = sorted((r.sequence_id, place[r.doc_id], r.start) for r in got if r.offset == 0)
        assert [x[1:] for x in first] == sorted(x[1:] for x in first)
        return sorted((r.doc_id, r.start, r.sequence_id, r.offset) for r in got)

    plenty = packed({"a": 0.1, "b": 0.9})
    even = packed({"a": 0.8, "b": 0.2})
    assert plenty != even and [r[:2] for r in plenty] == [r[:2] for r in even]
