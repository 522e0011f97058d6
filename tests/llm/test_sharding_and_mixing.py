import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from airgrid.llm.mixing import mix, tree_paths
from airgrid.llm.numbering import number_rows, scatter
from airgrid.llm.sharding import assign_shards, jump_shards, shard_documents

DOCS = "doc_id long, text string, source string"


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_equals_published_values(spark):
    known = [(1, 1, 0), (42, 57, 43), (0xDEAD10CC, 1, 0), (0xDEAD10CC, 666, 361), (256, 1024, 520)]
    for key, n, shard in known:
        row = spark.range(1).select(jump_shards(F.lit(key), [n])[f"n{n}"].alias("s")).first()
        assert row.s == shard == jump(key, n)


def test_jump_equals_brute_force_and_only_moves_to_the_new_shard(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(1000, 1400)]
    df = spark.createDataFrame([(k, "x") for k in keys], "doc_id long, shard string")
    for r in assign_shards(df, "doc_id", 24, grown="more").collect():
        assert (r.shard, r.more) == (jump(r.doc_id, 24), jump(r.doc_id, 25))
        assert r.shard == r.more or r.more == 24


def test_shard_documents_with_nulls_repeats_and_clashing_names(spark):
    rows = [(i, "é" * (i % 5), "s") for i in range(200)] + [(7, None, None), (7, "a", "b")]
    rows += [(None, "n", "s"), (3, "ééé", "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {"shard": F.lit("x"), "size": F.lit(1), "slot": F.lit(None)}
    )
    got = shard_documents(docs, 24, block_rows=4).collect()
    want = Counter()
    for doc, text, _ in rows:
        data = (text or "").encode()
        want[doc, len(data) + 8, zlib.crc32(data), jump(doc or 0, 24), jump(doc or 0, 25)] += 1
    assert want == Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_documents(docs.limit(0), 24).count() == 0


def test_numbers_follow_the_order_over_blocks(spark):
    df = spark.range(500).select("id", (F.col("id") % 3 == 0).alias("g"), scatter(F.col("id")).alias("o"))
    df = df.withColumn("b", F.substring("o", 1, 1))
    got = number_rows(df, "n", ["g"], "b", [F.col("o")]).collect()
    for g in (True, False):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.o)
        assert [r.n for r in mine] == list(range(len(mine)))


def earliest_deadline_first(units, frame):
    used, order = Counter(), []
    for now in range(frame):
        ready = [
            (math.ceil((used[s] + 1) * frame / u), s)
            for s, u in sorted(units.items())
            if used[s] < u and used[s] * frame // u <= now
        ]
        order.append(min(ready)[1])
        used[order[-1]] += 1
    return order


def test_mixture_is_the_pfair_schedule(spark):
    sizes = {"a": 300, "b": 90, "c": 40, None: 21, "": 9}
    rows = [(i, f"t{i}", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"slot": F.lit("x"), "units": F.lit(1)})
    weights = {"a": 0.5, "b": 0.3, "c": 0.1, "": 0.05}
    got = mix(docs, weights, frame=41, block_rows=2, numbering_rows=8).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, _, s in rows)
    got.sort(key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    assert [r.slot for r in got] == sorted(r.slot for r in got)
    # Shares 0.5, 0.3, 0.1, 0.05, 0.05 (null weighs like the lightest source) of the 36 slots that
    # are left after one for each: 18, 10.8, 3.6, 1.8, 1.8; three more by largest remainders.
    units = {"=a": 19, "=b": 12, "=c": 4, "=": 3, "null": 3}
    order = earliest_deadline_first(units, 41)
    key = lambda s: "null" if s is None else f"={s}"
    assert all(order[r.slot % 41] == key(r.source) for r in got)
    turns = defaultdict(set)
    for r in got:
        turns[r.source].add((r.source_block, r.slot))
    for s, pairs in turns.items():
        blocks = sorted(pairs)
        assert [b for b, _ in blocks] == list(range(len(blocks)))
        assert [x for _, x in blocks] == sorted(x for _, x in blocks)


def test_mixture_stays_within_one_block_of_its_weights():
    units = {f"s{i}": u for i, u in enumerate([400, 301, 150, 100, 50, 20, 3])}
    order, used = earliest_deadline_first(units, 1024), Counter()
    for now, s in enumerate(order, 1):
        used[s] += 1
        assert all(abs(used[x] - u * now / 1024) < 1 for x, u in units.items())


def test_mixture_edge_cases(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mix(empty).count() == 0
    one = spark.createDataFrame([(None, None, None)] * 3, DOCS)
    assert sorted(r.position for r in mix(one, frame=4).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        mix(one, {"a": 0.0})


def climbed(path, n):
    for own, whole, left in path:
        n = (whole * (2 * n + 1) - left) // (2 * own)
    return n


def test_tree_keeps_to_the_target_weights_over_many_frames():
    hot = {n: [(n / 2) ** 0.7] + [1.0] * (n - 1) for n in (2, 20, 200, 800, 1500)}
    for weights in [*hot.values(), [0.5] + [0.5 / 99] * 99, [0.49, 0.5, 0.01], [1e-9, 1.0], [5.0]]:
        total = sum(weights)
        whole = {f"s{i}": max(1, round(w / total * 2**30)) for i, w in enumerate(weights)}
        paths, slots = tree_paths(whole), 20 * 1024
        taken = []
        for i, w in enumerate(weights):
            turn = 0
            while (slot := climbed(paths[f"s{i}"], turn)) < slots:
                # Before and after each block, against the weight itself.
                assert abs(turn - slot * w / total) < 2 and abs(turn + 1 - (slot + 1) * w / total) < 2
                taken.append(slot)
                turn += 1
            assert abs(turn - slots * w / total) < 2
        assert sorted(taken) == list(range(slots))


def test_mixture_by_weights_has_target_shares_and_any_number_of_sources(spark):
    sizes = {"hot": 3000} | {f"s{i:02d}": 30 for i in range(99)} | {None: 5}
    rows = [(i, f"t{i}", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    weights = {"hot": 0.5} | {f"s{i:02d}": 0.5 / 100 for i in range(99)}
    got = mix(docs, weights, frame=16, block_rows=2, numbering_rows=64, law="weights").collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, _, s in rows)
    got.sort(key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    assert [r.slot for r in got] == sorted(r.slot for r in got)
    key = lambda s: "null" if s is None else f"={s}"
    total = sum(weights.values()) + 0.5 / 100
    whole = {key(s): round(weights.get(s, 0.5 / 100) / total * 2**30) for s in sizes}
    paths = tree_paths(whole)
    assert all(r.slot == climbed(paths[key(r.source)], r.source_block) for r in got)
    used, last = Counter(), 3 * 100 * 2  # slots in which no source has run out
    for slot, s in sorted({(r.slot, r.source) for r in got})[:last]:
        used[s] += 1
        assert abs(used["hot"] - (slot + 1) * 0.5 / total) < 2
    assert mix(docs.limit(0), law="weights").count() == 0
    with pytest.raises(ValueError):
        mix(docs, law="other")
