import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from airgrid.llm import fingerprints as fp

DOCS = "doc_id long, text string"
MASK = 2**64 - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def toss(symbols):
    out = [symbols[0] & 1]
    for left, own in zip(symbols, symbols[1:], strict=False):
        differ = left ^ own
        place = (differ & -differ).bit_length() - 1
        out.append(2 * place + ((own >> place) & 1))
    return out


def parse(symbols):
    runs = []
    for x in symbols:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    symbols = [x if n == 1 else mix((x * 0x9E3779B97F4A7C15 + n) & MASK) for x, n in runs]
    labels = symbols
    for _ in range(4):
        labels = toss(labels)
    assert all(a != b for a, b in zip(labels, labels[1:], strict=False)) and max(labels) < 6
    cuts = [0] + [
        i for i in range(1, len(labels) - 1) if labels[i - 1] < labels[i] > labels[i + 1]
    ]
    names = []
    for a, b in zip(cuts, [*cuts[1:], len(symbols)], strict=True):
        total = sum(mix(((s + i * 0x9E3779B97F4A7C15) * 0x94D049BB133111EB) & MASK) for i, s in enumerate(symbols[a:b]))
        names.append(mix((total + b - a) & MASK))
    return names


def fields(text, rounds):
    names = [ord(c) for c in text]
    for _ in range(rounds):
        names = parse(names) if names else names
    out = [0xFFFF] * 64
    for name in names:
        name = mix((name + 0x9E3779B97F4A7C15) & MASK)
        out[name % 64] = min(out[name % 64], (name >> 6) % 0xFFFF)
    return out


def some_text(rng, n):
    return "".join(rng.choices("abcdeé 中🙂\n", k=n))


def test_parsing_equals_brute_force():
    rng = random.Random(4)
    texts = ["", "a", "aa", "aaaaaaab", "ab" * 50, "\x00\x00\x01", *(some_text(rng, n) for n in (2, 3, 7, 50, 900))]
    texts += ["x" * 1000 + some_text(rng, 30)]
    for rounds in (0, 1, 3):
        got = fp.fingerprint_fields(texts, rounds)
        assert got.tolist() == [fields(t, rounds) for t in texts]


def test_chunks_do_not_matter(monkeypatch):
    rng = random.Random(4)
    texts = [some_text(rng, rng.randrange(200)) for _ in range(60)]
    want = fp.fingerprint_fields(texts, 3)
    monkeypatch.setattr(fp, "_CHUNK", 150)
    assert np.array_equal(fp.fingerprint_fields(texts, 3), want)


def test_equal_substrings_share_inner_names_at_any_offset():
    rng = random.Random(9)
    core = some_text(rng, 600)
    names = []
    for lead in range(12):
        symbols = np.array([ord(c) for c in some_text(rng, lead) + core], np.uint64)
        owner = np.zeros(len(symbols), int)
        for _ in range(3):
            symbols, owner = fp._round(symbols, owner)
        names.append(symbols.tolist())
    inner = names[0][3:]
    assert len(inner) > 15
    assert all(any(n[i:] == inner for i in range(len(n))) for n in names)


def test_likeness_estimates_common_phrases():
    rng = random.Random(2)
    base = some_text(rng, 4000)
    same, half, other = fp.fingerprint_fields([base, base[:2000] + some_text(rng, 2000), some_text(rng, 4000)], 3)
    whole = fp.fingerprint_fields([base], 3)[0]
    assert fp.likeness(whole, same) == 1
    assert 0.15 < fp.likeness(whole, half) < 0.55 and fp.likeness(whole, other) < 0.1
    assert np.array_equal(fp.unspelled(fp.spelled(whole[None])[0]), whole)
    empty = fp.fingerprint_fields([""], 3)[0]
    assert fp.likeness(empty, empty) == 1 and fp.likeness(empty, whole) == 0


def check_edits(docs, rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        own, changed, following = fp.fingerprint_fields([text, new, after], 3)
        want.append(
            (
                doc,
                len(text),
                hashlib.sha256(new.encode()).hexdigest(),
                fp.spelled(own[None])[0],
                fp.spelled(changed[None])[0],
                float(fp.likeness(own, changed)),
                float(fp.likeness(own, following)),
            )
        )
    got = [tuple(r) for r in fp.fingerprint_edits(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_edits_meet_the_next_document_over_partitions(spark):
    rng = random.Random(7)
    rows = [(i * 3, some_text(rng, rng.randrange(300))) for i in range(700)]
    rows += [(1, None), (2, ""), (4, some_text(rng, 60_000)), (None, "null id")]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    check_edits(docs.withColumns({"part": F.lit("x"), "edge": F.lit(1)}), rows)


def test_edit_edge_cases(spark):
    assert fp.fingerprint_edits(spark.createDataFrame([], DOCS)).count() == 0
    check_edits(spark.createDataFrame([(5, "a single document")], DOCS), [(5, "a single document")])
    rows = [(5, "same row")] * 4 + [(6, "other row of text")]
    check_edits(spark.createDataFrame(rows, DOCS), rows)


def test_fingerprint_column(spark):
    rows = [(1, "one text"), (2, "one text"), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fingerprint", F.lit(7))
    got = {r.doc_id: r.fingerprint for r in fp.fingerprint_documents(docs).collect()}
    assert got[1] == got[2] != got[3] == got[None]
