"""Spelling variants against plain edit distances and plain counting."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airgrid.llm.spelling import count_words, follow_forms, group_spellings, near_words

DOCS = "doc_id long, text string, lang string"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows, one_in):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_groups(counts):
    out = {}
    for word, n in counts.items():
        near = sorted((-m, x) for x, m in counts.items() if one_edit(word, x))
        form = near[0] if near and -near[0][0] >= 5 * n else None
        out[word] = [form and form[1], n, len(near), form and -form[0]]
    for word, row in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        row.insert(1, root)
    return sorted((w, *r) for w, r in out.items())


def corpus(seed, documents):
    rng = random.Random(seed)
    syllables = ["an", "be", "ber", "ca", "é", "Î", "the", "to", "ti", "on", "x", "À", "÷", "nn"]
    words = ["".join(rng.choices(syllables, k=rng.randint(2, 5))) for _ in range(60)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aabaaa", "Banana", "BANANAS", "bananna"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = []
    for i in range(documents):
        drawn = rng.choices(words, weights, k=rng.randint(0, 60))
        for j in range(len(drawn)):
            if rng.random() < 0.3:
                at = rng.randrange(len(drawn[j]))
                drawn[j] = drawn[j][:at] + rng.choice(["", "e", drawn[j][at] * 2]) + drawn[j][at + 1 :]
        texts.append((i, rng.choice([" ", ", ", "1", "\n", "ł"]).join(drawn)))
    return texts


@pytest.mark.parametrize("part_words", [20_000, 7])
def test_equals_brute_force(spark, part_words):
    rows = corpus(1, 150) + [(900, None), (901, ""), (902, "漢字 123 _"), (None, "banana " * 9)]
    rows += rows[3:6]  # repeated rows count each
    rows.append((904, "lantern " * 300 + "lanternn " * 50 + "lanternnn " * 6))
    rows.append((903, ("Bananen" * 40_000) + " " + "thorough " * 150_000))  # very long run and text
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS).repartition(7)
    clashing = docs.withColumns({c: F.lit("?") for c in ("word", "n", "side", "half", "cell", "part", "root")})
    counts = brute_counts(rows, 19)
    got = group_spellings(clashing, drop_one_in=19, part_words=part_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_groups(counts)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert ("lanternnn", "lanternn", "lantern", 6, 1, 50) in want  # chains of more than one step


def test_all_edits_of_repeating_symbols_and_long_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(200)}
    words |= {"q" * 600, "q" * 601, "q" * 300 + "r" + "q" * 300}
    table = spark.createDataFrame([(w, 5 + len(w)) for w in words], "word string, n long")
    want = sorted((a, b, 5 + len(b)) for a in words for b in words if one_edit(a, b))
    for part_words in (50, 20_000):
        pairs = near_words(table, part_words).distinct().collect()
        assert sorted(tuple(r) for r in pairs) == want


def test_no_words_ties_and_counts(spark):
    empty = spark.createDataFrame([], DOCS)
    assert group_spellings(empty).collect() == []
    assert group_spellings(spark.createDataFrame([(1, None, "x")], DOCS)).collect() == []
    text = "zabcdef " * 30 + "aabcdef " * 30 + "abcdef " * 6
    rows = group_spellings(spark.createDataFrame([(1, text, "x")], DOCS), drop_one_in=0).collect()
    by_word = {r.word: (r.form, r.n_near, r.form_n) for r in rows}
    assert by_word == {
        "abcdef": ("aabcdef", 2, 30),  # of two equally frequent ones the least
        "aabcdef": (None, 2, None),
        "zabcdef": (None, 2, None),
    }
    counted = count_words(spark.createDataFrame([(1, "MÉTIER métier " * 3, "x")], DOCS), drop_one_in=0)
    assert sorted(counted.collect()) == []  # only A-Z are lower-cased: three of each


def test_chains_are_followed_to_their_end(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}" if i < 40 else None) for i in range(41)] + [("lone", None)]
    roots = follow_forms(spark.createDataFrame(chain, "word string, form string")).collect()
    assert sorted(tuple(r) for r in roots) == sorted([("lone", "lone"), *((f"w{i:03}", "w040") for i in range(41))])
