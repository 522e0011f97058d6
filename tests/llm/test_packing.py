import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from airgrid.llm.packing import (
    ChunkEncoder,
    pack_documents,
    pack_histogram,
    rank_ranges,
    vocabulary_path,
)


@pytest.fixture(scope="module")
def direct():
    return Tokenizer.from_file(vocabulary_path())


TEXTS = [
    "",
    " ",
    "Hello, world!! it's we'll I'm x'y ''s",
    "ÉTÉ Straße ÿŸ Ünïcödé naïvé é İstanbul ΣΑΣ ß",
    "a<|endoftext|>b <|startoftext|> <|endoftext|>. <|x|>",
    "tab\there nbsp em\x1cfs\x85nel​zw a　b",
    "12 3a4 x9, ½ ² ٣ 中文字 日本 🙂🙂 --__-- ***$$$",
    "word.word,word;word (a) [b] {c} a/b c\\d e|f ~`^",
    "supercalifragilisticexpialidocious" * 30,
    "\r\n\n x\r y\n",
]


def test_chunks_give_the_tokenizers_ids(direct):
    rng = random.Random(5)
    alphabet = "abcXYZ éÉßñÑ'’.,!?-_*$ \n\t0129½<|>中🙂́İΣς"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    encoder = ChunkEncoder(vocabulary_path(), limit=50)
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == direct.encode(text, add_special_tokens=False).ids, repr(text)


def one_at_a_time(histogram, capacity):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            best = max(range(len(rooms)), key=lambda i: rooms[i], default=None)
            if best is None or rooms[best] < length:
                rooms.append(capacity - length)
            else:
                rooms[best] -= length
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=12))
def test_patterns_equal_packing_one_piece_at_a_time(histogram):
    patterns = pack_histogram(histogram, 32)
    total, rooms = Counter(), []
    for sequences, pattern in patterns:
        room = 32 - sum(length * copies for length, copies in pattern)
        assert room >= 0 and sequences > 0
        rooms += [room] * sequences
        for length, copies in pattern:
            total[length] += copies * sequences
    assert total == Counter(histogram)
    assert sorted(rooms) == one_at_a_time(histogram, 32)
    seen = defaultdict(list)
    for length, first, after, _, sequences, _ in rank_ranges(patterns):
        assert first < after and (after - first) % sequences == 0
        seen[length] += range(first, after)
    assert all(sorted(r) == list(range(histogram[n])) for n, r in seen.items())


def test_too_long_pieces_are_refused():
    with pytest.raises(ValueError):
        pack_histogram({9: 1}, 8)


def test_documents_are_packed_whole(spark, direct):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["ab", "xyz,", "Éa", "the"], k=rng.randrange(80)))) for i in range(120)]
    rows += [(None, "null id"), (3, None), (4, ""), (5, "copy here"), (5, "copy here"), *enumerate(TEXTS)]
    docs = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "doc_id long, text string, length string, offset int"
    )
    got = pack_documents(docs, capacity=64, keep_ids=True, block_rows=16).collect()
    want = Counter()
    for doc, text in rows:
        ids = [*direct.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 64):
            piece = np.array(ids[at : at + 64], "<u4").tobytes()
            want[doc, at, len(piece) // 4, zlib.crc32(piece), len(ids), piece] += 1
    pieces = Counter(
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in got
    )
    assert pieces == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    used = sum(r.length for r in got)
    assert len(sequences) <= used / 64 * 1.05 + 1
    assert pack_documents(docs.limit(0)).count() == 0
