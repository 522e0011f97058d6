import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from airgrid.llm import ngram_join
from airgrid.llm.components import components
from airgrid.llm.line_dedup import dedup_lines
from airgrid.llm.ngram_join import least_agreements, one_of_each, similar_documents

DOCS = "doc_id long, text string"


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    if text is None:
        return None
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else text


def linked(a, b):
    if not (isinstance(a, frozenset) and isinstance(b, frozenset)):
        return a is not None and a == b
    common = len(a & b)
    return 5 * common >= 4 * (len(a) + len(b) - common)


def check_similar(docs, rows, **options):
    sets = [grams(t) for _, t in rows]
    links = [{j for j in range(len(rows)) if j != i and linked(sets[i], sets[j])} for i in range(len(rows))]
    root = list(range(len(rows)))
    for start in range(len(rows)):
        todo = [start] if root[start] == start else []
        while todo:
            for j in links[todo.pop()]:
                if root[j] > start:
                    root[j] = start
                    todo.append(j)
    members = {}
    for i, r in enumerate(root):
        members.setdefault(r, []).append(rows[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()}
    want = sorted(
        (repr(d), repr(d if sets[i] is None else least[root[i]]), len(links[i])) for i, (d, _) in enumerate(rows)
    )
    got = similar_documents(docs, **options)
    found = sorted((repr(r.doc_id), repr(r.class_id), r.n_links) for r in got.collect())
    assert found == want
    return got, want


def near_copies(rng, base, count, edits):
    out = []
    for _ in range(count):
        words = base.split()
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_join_equals_brute_force(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 120))) for _ in range(60)]
    for _ in range(6):
        texts += near_copies(rng, " ".join(rng.choices(words, k=90)), 12, 5)
    # One large group of near copies, copies of one text, and a passage that many texts share.
    texts += near_copies(rng, " ".join(rng.choices(words, k=100)), 70, 4)
    texts += ["same words in every one of these texts"] * 40
    passage = " ".join(rng.choices(words, k=50))
    texts += [f"{passage} {' '.join(rng.choices(words, k=rng.randrange(8, 60)))}" for _ in range(40)]
    texts += ["Same, words IN every one of these texts!", "one", "one", "two words", "", "...", None, "", None]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    docs = docs.withColumns({"set_id": F.lit("x"), "group_id": F.lit(2), "copies": F.lit(1), "family": F.lit(None)})
    check_similar(docs, rows, hot=8, block=16)


def test_join_edge_cases(spark):
    empty = spark.createDataFrame([], DOCS)
    assert similar_documents(empty).count() == 0
    text = "a b c d e f g h i j"
    rows = [(1, text), (1, text), (None, text), (1, "other text here"), (2, None), (None, None), (9, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got, _ = check_similar(docs, rows)
    kept = sorted((repr(r.doc_id), repr(r.text)) for r in one_of_each(docs, got).collect())
    assert ("9", "'x'") in kept and ("2", "None") in kept and ("None", "None") in kept
    assert ("1", repr(text)) in kept and ("1", "'other text here'") in kept and len(kept) == 5


def test_one_of_each_keeps_the_least_id(spark):
    rows = [(i, f"group {i % 4} has these ten words and no others at all") for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("class_id", F.lit("x"))
    got = one_of_each(docs, similar_documents(docs))
    assert sorted(r.doc_id for r in got.collect()) == [0, 1, 2, 3]
    assert got.columns == ["doc_id", "text", "class_id"]


def test_least_agreements_is_the_posterior_rule():
    least = least_agreements(96, 0.8, 1e-6)
    rng = np.random.default_rng(0)
    for n, m in ((16, int(least[16])), (96, int(least[96]))):
        for agreed, kept in ((m, True), (m - 1, False)):
            draws = rng.beta(agreed + 1, n - agreed + 1, 2_000_000)
            chance = (draws >= 0.8).mean()
            assert chance >= 2e-7 if kept else chance <= 5e-6


def test_long_texts_are_hashed_whole():
    words = [f"w{i}" for i in range(200_000)]
    one = ngram_join.ngram_set(" ".join(words), 5)
    other = ngram_join.ngram_set(" ".join([*words[:-1], "end"]), 5)
    assert len(one) == 199_996 and len(np.intersect1d(one, other)) == 199_995


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(60)]
    edges += edges[:20] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((x, find(x)) for x in root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


SPACE = " \t\r\f\v"


def brute_lines(rows, order, min_chars):
    seen, out = [], {}
    for i in order:
        doc, text = rows[i]
        if text is None:
            out[i] = (None, 0, 0)
            continue
        lines = text.split("\n")
        kept = []
        for at, raw in enumerate(lines):
            line = raw.strip(SPACE)
            gone = line != "" and any(
                line == s or (min(len(line), len(s)) >= min_chars and one_edit(line, s)) for s in seen
            )
            if line:
                seen.append(line)
            if not gone:
                kept.append(lines[at])
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def mutate(rng, line):
    at = rng.randrange(len(line) + 1)
    return rng.choice(
        [line[:at] + rng.choice("abcé") + line[at:], line[:at] + line[at + 1 :], line[:at] + "z" + line[at + 1 :]]
    )


def test_lines_equal_brute_force(spark):
    rng = random.Random(8)
    base = ["".join(rng.choices("abc é", k=rng.choice([3, 8, 12, 17, 18, 33, 90]))) for _ in range(60)]
    rows = []
    for doc in range(60):
        lines = [rng.choice(base) for _ in range(rng.randrange(8))]
        lines = [mutate(rng, x) if rng.random() < 0.5 else x for x in lines]
        lines = [mutate(rng, x) if rng.random() < 0.2 else x for x in lines]
        lines += [" " + rng.choice(base) + "\t", "", "  "][: rng.randrange(4)]
        rng.shuffle(lines)
        rows.append((doc, "\n".join(lines)))
    # One line with many neighbours that are two edits from each other.
    common = "the line that stands in very many documents"
    rows += [(100 + i, f"{common[:i]}#{common[i + 1 :]}\n{common}") for i in range(len(common))]
    rows += [(200 + i, "page number one hundred and " + str(i)) for i in range(30)]
    rows += [(300, ""), (301, None), (302, "\n\n")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    docs = docs.withColumns({"id": F.lit(1), "at": F.lit("x"), "line": F.lit("y"), "n_lines": F.lit(9)})
    for least in (0, 10):
        got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in dedup_lines(docs, min_chars=least).collect()}
        want = brute_lines(rows, range(len(rows)), least)
        assert got == {rows[i][0]: w for i, w in want.items()}


def test_line_edge_cases(spark):
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(5, "one line of text here\nx"), (5, "one line of text here\nx"), (None, "x\nlong"), (7, "y")]
    got = dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    # Equal rows are one document, and ids that are null come last.
    assert sorted((repr(r.doc_id), r.text) for r in got) == sorted(
        [("5", rows[0][1]), ("5", rows[0][1]), ("None", "long"), ("7", "")]
    )
    short = [(1, "Short heading"), (2, "Short headin"), (3, "Short headingg"), (4, "ab"), (5, "b"), (6, "c")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(short, DOCS)).collect()}
    assert got == {1: "Short heading", 2: "", 3: "", 4: "ab", 5: "", 6: ""}
    long = "\n".join(f"line {i} of a very long document, {'x' * (i % 50)}" for i in range(3000))
    got = dedup_lines(spark.createDataFrame([(1, long), (2, long)], DOCS), min_chars=10**6).collect()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text == long and by_id[1].n_dropped == 0
    assert by_id[2].text == "" and by_id[2].n_dropped == 3000


def test_every_pair_of_variants_is_met(spark):
    line = "abcdefghijklmnopqrst"
    others = [line[:i] + c + line[j:] for i, (c, d) in itertools.product(range(20), [("", 1), ("_", 0), ("_", 1)]) for j in [i + d]]
    rows = [(0, line), *((i + 1, x) for i, x in enumerate(sorted(set(others))))]
    got = dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert all(r.text == ("" if r.doc_id else line) for r in got)
