"""Token alignment against whole texts, plain sets of offsets and plain counting."""

import hashlib
from bisect import bisect_left
from collections import Counter

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airgrid.llm.alignment import _aligner, align_tokens, common_ends, gallop
from airgrid.llm.tables import read

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
NAMES = ("byte_bpe_50k.json", "piece_bpe_32k.model")

ODD = [
    "", " ", "  ", "\n", "a", " a ", "a  b", "a \n b", "a\n\n b\t\tc ", "x;\r\ny", "();\r\n\r\n  z", " a 　b",
    "<s>tag</s> <|endoftext|> <unk> <0x41>", "mark ▁ here", "é à ÿ ﬁ ①", "漢字かな交じり文", "🙂🙂🏽 👩‍👩‍👧", "it's we'll I'D",
    "\x00\x01 \x7f", "a" * 700, "1234567 12,345.67", "tabs\tand\vfeeds\f\x85 end", "﻿start", "éä",
    "<s>", "\r", "a\r", "a \r b", "    def f(x):\n        return x\n", "ends in newline\n", "ends in blanks   ", "़ि‍",
]


def whole(text):
    """n_a, n_b, groups and links of a whole text, by sets of offsets; None without tokens."""
    if not text:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    a = TOKENIZER.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    a_bytes = [bytes(byte_of[c] for c in TOKENIZER.id_to_token(i)) for i in a]
    b_bytes = []
    for i in b:
        piece = PIECES.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode())
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    ends = []
    for side in (a_bytes, b_bytes):
        at, out = 0, []
        for token in side:
            at += len(token)
            out.append(at)
        ends.append(out)
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        to_i, to_j = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(map(str, a[i:to_i])) + "|" + ",".join(map(str, b[j:to_j])))
        links += [(x, y) for x in a[i:to_i] for y in b[j:to_j]]
        i, j = to_i, to_j
    return len(a), len(b), groups, links


def expected(rows):
    found = [(doc, whole(text)) for doc, text in rows]
    counts = Counter(pair for _, x in found if x for pair in set(x[3]))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for doc, x in found:
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = x
        best = sum(counts[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def test_equals_whole_texts_and_plain_counts(spark):
    texts = [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").limit(60).collect()]
    rows = [(i, t) for i, t in enumerate(ODD + texts)] + [(500, None), (None, "a b"), (501, "the the " * 4000)]
    rows += rows[3:9]  # repeated rows are documents of their own
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumns({c: F.lit("x") for c in ("row", "pair", "pairs", "times", "n_a", "links", "width", "rest")})
    want = sorted(expected(rows), key=key)
    for common in (100_000, 40, 0):
        got = align_tokens(docs, common_pairs=common)
        assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
        assert sorted((tuple(r) for r in got.collect()), key=key) == want
    kept = {r.doc_id: r for r in align_tokens(docs, keep_groups=True).collect()}
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in kept.values() if r.n_a)


def test_empty_table_and_tables_without_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert align_tokens(docs.limit(0)).collect() == []
    assert sorted(tuple(r) for r in align_tokens(docs).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aTé漢🙂 \n\t\r ▁.,;'()<>/s0189_-\x00　́‍\x85\v"), max_size=40))
def test_segments_are_aligned_as_in_the_whole_text(text):
    aligner = _aligner(*NAMES)
    segments = aligner.segments(f" {text}")
    assert "".join(segments) == " " + text
    aligner.learn(set(segments))
    got, want = aligner.align(segments), whole(text)
    if want is None:
        assert got is None or not text
    else:
        assert got[:3] == (want[0], want[1], len(want[2])) and got[3] == ";".join(want[2])
        links = Counter(a * aligner.width + b for a, b in want[3])
        assert dict(zip(got[4].tolist(), got[5].tolist(), strict=True)) == links


@given(st.sets(st.integers(0, 200)), st.sets(st.integers(0, 200)))
def test_common_ends_are_the_intersection(a, b):
    a, b = sorted(a), sorted(b)
    both = sorted(set(a) & set(b))
    assert common_ends(a, b) == [(a.index(x) + 1, b.index(x) + 1) for x in both]
    for start in range(len(b) + 1):
        for target in (0, 57, 200):
            assert gallop(b, target, start) == max(start, bisect_left(b, target, start))
