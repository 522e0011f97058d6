"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids go together.

Both tokenizers' tokens of a text are lists of byte offsets at which they end. The shorter list
gallops through the longer one: from the last place found, steps of doubling width and then a
binary search between the last two. The common offsets cut the text into groups; the ranks of a
common offset in both lists say which tokens of either side lie in a group. Every token of one side
is linked with every token of the other side in its group.

White space at which both tokenizers always cut divides a text into segments whose tokens don't
depend on what stands around them, so a segment is tokenised and aligned once and remembered.

How many documents hold a pair of ids is counted in Spark. The commonest pairs, a fixed number, go
to every task; the others are joined by shuffle, where no pair is common enough to be a hot key.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage

# The usual pattern of byte-level vocabularies, a fixed value.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def gallop(ends: Sequence[int], target: int, start: int) -> int:
    """The least index from `start` on at which ends[index] >= target; len(ends) if there is none."""
    low, step = start, 1
    while low + step <= len(ends) and ends[low + step - 1] < target:
        low += step
        step *= 2
    return bisect_left(ends, target, low, min(low + step, len(ends)))


def common_ends(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """(tokens of a, tokens of b) that lie before each offset at which tokens of both end.

    a and b are strictly increasing. The shorter one drives the search through the longer one.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    out, at = [], 0
    for i, end in enumerate(short):
        if long[at] < end:
            at = gallop(long, end, at + 1)
        if at < len(long) and long[at] == end:
            at += 1
            out.append((i + 1, at))
        if at == len(long):
            break
    return out if short is a else [(y, x) for x, y in out]


def linked_ids(a: Sequence[int], b: Sequence[int], width: int) -> tuple[list[int], list[int]]:
    """Packed pairs `a * width + b` of a group's ids and how many links each entry stands for; in
    a large group every pair has one entry."""
    if len(a) * len(b) <= 64:
        pairs = [x * width + y for x in a for y in b]
        return pairs, [1] * len(pairs)
    a_ids, a_times = np.unique(np.asarray(a, np.int64), return_counts=True)
    b_ids, b_times = np.unique(np.asarray(b, np.int64), return_counts=True)
    pairs = (a_ids[:, None] * width + b_ids).reshape(-1)
    return pairs.tolist(), np.outer(a_times, b_times).reshape(-1).tolist()


def byte_level_encoder(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """How to encode a text by a byte-level vocabulary file, and the bytes of its entries by id.

    Strings of special tokens are ordinary text. Merges that make entries in the order of their
    ids, under the usual pattern, are done by the faster of two libraries.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    # Byte-level entries show printable bytes as themselves, the rest from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in described["added_tokens"]}
    entries = {e: i for e, i in described["model"]["vocab"].items() if e not in special}
    spelled = [b""] * (1 + max(entries.values()))
    for entry, i in entries.items():
        spelled[i] = bytes(byte_of[c] for c in entry)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in described["model"]["merges"]]
    made = [entries["".join(m)] for m in pairs]
    before, model = described["pre_tokenizer"], described["model"]
    plain = described["normalizer"] is None and before["type"] == "ByteLevel" and before["use_regex"]
    plain = plain and not before["add_prefix_space"] and not model.get("ignore_merges")
    if plain and made == sorted(set(made)) and sorted({*range(256), *made}) == sorted(entries.values()):
        import tiktoken

        ranks = {spelled[i]: i for i in entries.values()}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, spelled
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, spelled


class Aligner:
    """Aligned segments, remembered up to `limit` of them. One per Python worker.

    A text is cut in front of white space that no piece holds (a space only starts pieces) and
    between a letter and a mark that no piece holds next to each other; the byte-level vocabulary's
    pattern starts a new word at all these places too.
    """

    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    MARKS = '.,;:!?)"'  # no apostrophe: the pattern keeps some words with theirs

    def __init__(self, byte_level: str, pieces: str, limit: int = 140_000):
        import sentencepiece

        self.encode_a, self.a_bytes = byte_level_encoder(byte_level)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        spelled = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        is_byte = [self.b.is_byte(i) for i in range(len(spelled))]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode("utf-8", "surrogatepass")
            for p, byte in zip(spelled, is_byte, strict=True)
        ]
        self.a_size = list(map(len, self.a_bytes))
        self.space, self.width = self.b.piece_to_id("▁"), len(spelled)
        self.numbers = list(map(str, range(max(self.width, len(self.a_bytes)))))
        words = [p for p, byte in zip(spelled, is_byte, strict=True) if not byte]
        held = {c for p in words for c in p if c.isspace()}
        beside = {(x, y) for p in words for x, y in zip(p, p[1:], strict=False)}
        # A segment that does not start with a space is encoded behind a newline of its own.
        cuts = []
        if "\n" not in held:
            free = "".join(c for c in "\n\t" if c not in held)
            if not any(x != "▁" and y == "▁" for x, y in beside):
                free += " "
            letter = re.compile(f"[{self.LETTERS}]").fullmatch
            taken = {y for x, y in beside if letter(x)}
            marks = "".join(re.escape(c) for c in self.MARKS if c not in taken)
            cuts = [f"(?<=\\S)(?=[{free}])", *[f"(?<=[{self.LETTERS}])(?=[{marks}])"] * bool(marks)]
        self.segments = re.compile("|".join(cuts) or "(?!)").split
        self.limit = limit
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _pieces(self, segments: list[str]) -> Iterator[list[int]]:
        """Side B's ids of segments, as they are inside a text: the piece model writes a space
        before every text, and a segment's own space stands for it."""
        spaced = [s.startswith(" ") for s in segments]
        each = [s[1:] if x else "\n" + s for s, x in zip(segments, spaced, strict=True)]
        for segment, ids, own in zip(segments, self.b.encode(each, num_threads=1), spaced, strict=True):
            yield ([self.space] if len(segment) == 1 else ids) if own else ids[2:]

    def learn(self, segments: set[str]) -> None:
        """Remember segments: n_a, n_b, groups as text, packed pairs as bytes and their links as
        bytes, or none if all are one; None where the tokens' bytes are not the segment's."""
        new = [s for s in segments if s not in self.known]
        if len(self.known) + len(new) > self.limit // 2:
            # What has been used since the last time stays in reach, the rest is forgotten.
            self.older, self.known, new = self.known, {}, list(segments)
        again = self.older.keys() & new
        self.known.update((s, self.older[s]) for s in again)
        new = [s for s in new if s not in again]
        for segment, more in zip(new, self._pieces(new), strict=True):
            self.known[segment] = self._aligned(segment, self.encode_a(segment), more)

    def _aligned(self, segment: str, ids: list[int], more: list[int]) -> tuple | None:
        spelled = segment.encode("utf-8", "surrogatepass")
        b_bytes = [self.b_bytes[i] for i in more]
        a_ends = list(accumulate([self.a_size[i] for i in ids]))
        if b"".join(b_bytes) != spelled or a_ends[-1] != len(spelled):
            return None
        numbers, width, whole = self.numbers, self.width, True
        groups, pairs, times, i, j = [], [], [], 0, 0
        for to_i, to_j in common_ends(a_ends, list(accumulate(map(len, b_bytes)))):
            if to_i - i == 1 == to_j - j:
                groups.append(f"{numbers[ids[i]]}|{numbers[more[j]]}")
                pairs.append(ids[i] * width + more[j])
                times.append(1)
            else:
                own, other = ids[i:to_i], more[j:to_j]
                groups.append(
                    ",".join([numbers[x] for x in own]) + "|" + ",".join([numbers[x] for x in other])
                )
                linked, stands_for = linked_ids(own, other, width)
                whole = whole and len(own) * len(other) <= 64
                pairs += linked
                times += stands_for
            i, j = to_i, to_j
        packed = array("q", pairs).tobytes(), b"" if whole else array("q", times).tobytes()
        return len(ids), len(more), len(groups), ";".join(groups), *packed

    def align(self, segments: list[str]) -> tuple | None:
        """The same for a text of known segments, pairs once each and as arrays."""
        parts = [self.known[s] for s in segments]
        if None in parts:
            return None
        n_a, n_b, n_groups, groups, pairs, times = zip(*parts, strict=True)
        packed = np.frombuffer(b"".join(pairs), np.int64)
        if any(times):
            every = [t or array("q", [1] * (len(p) // 8)).tobytes() for p, t in zip(pairs, times, strict=True)]
            packed, at = np.unique(packed, return_inverse=True)
            # Sums of doubles, exact below 2 to the 53rd.
            links = np.bincount(at, np.frombuffer(b"".join(every), np.int64), len(packed)).astype(np.int64)
        else:
            packed, links = np.unique(packed, return_counts=True)
        return sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), packed, links


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(byte_level: str, pieces: str) -> Aligner:
    """One per Python worker, kept between tasks. Names without a folder are public vocabularies,
    looked up where the task runs."""
    if (byte_level, pieces) not in _ALIGNERS:
        paths = [byte_level, pieces]
        if any("/" not in p for p in paths):
            import public_tokenizers

            paths = [p if "/" in p else public_tokenizers.path(p) for p in paths]
        _ALIGNERS[byte_level, pieces] = Aligner(*paths)
    return _ALIGNERS[byte_level, pieces]


def aligned_documents(
    docs: DataFrame,
    byte_level: str = "byte_bpe_50k.json",
    pieces: str = "piece_bpe_32k.model",
    keep_groups: bool = False,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links, width and, if kept, groups.

    Side A encodes a space and the text with a byte-level vocabulary, side B the text with a piece
    model that writes the space itself. `groups` is `a1,a2|b1;a3|b2,b3`: the ids of both sides
    between common ends. pairs are `a * width + b` of the linked ids, each once, and links
    says how many links it stands for. A text that is null or empty, or that either side's tokens
    don't spell, has no tokens: zeros, empty lists and an empty digest.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces)
        for batch in batches:
            # About half a megabyte of text at a time, at least one document.
            sizes = np.nan_to_num(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            upto = np.cumsum(sizes + 64) // (1 << 19)
            starts = np.flatnonzero(np.diff(upto, prepend=-1))
            for at, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                yield of(aligner, batch.slice(at, end - at))

    def of(aligner: Aligner, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [aligner.segments(f" {t}") if t else [] for t in batch.column(1).to_pylist()]
        aligner.learn({s for segments in texts for s in segments})
        rows: list[list] = [[] for _ in range(8)]
        for segments in texts:
            found = aligner.align(segments) if segments else None
            n_a, n_b, n_groups, groups, pairs, links = found or (0, 0, 0, "", [], [])
            digest = hashlib.sha256(groups.encode()).hexdigest() if found else ""
            total = sum(links) if not found else int(links.sum())
            values = (n_a, n_b, n_groups, total, digest, pairs, links, groups)
            for column, value in zip(rows, values, strict=True):
                column.append(value)
        arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in rows[:4])]
        arrays.append(pa.array(rows[4], pa.string()))
        arrays += [pa.array(c, pa.list_(pa.int64())) for c in rows[5:7]]
        arrays.append(pa.array([aligner.width] * batch.num_rows, pa.int64()))
        arrays += [pa.array(rows[7], pa.string())] * keep_groups
        return pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links", "width"]
    names += ["groups"] * keep_groups
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    schema += "pairs array<long>, links array<long>, width long" + ", groups string" * keep_groups
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, documents (how many hold it linked) and best (whether no pair of its A id has more)."""
    counted = (
        aligned.select("width", F.explode("pairs").alias("pair"))
        .groupBy("pair")
        .agg(F.count(F.lit(1)).alias("documents"), F.first("width").alias("width"))
    )
    counted = cut_lineage(
        counted.select("pair", "documents", F.floor(F.col("pair") / F.col("width")).alias("a"))
    )
    most = counted.groupBy("a").agg(F.max("documents").alias("most"))
    return cut_lineage(
        counted.join(most, "a").select(
            "pair", "documents", (F.col("documents") == F.col("most")).alias("best")
        )
    )


def align_tokens(
    docs: DataFrame,
    byte_level: str = "byte_bpe_50k.json",
    pieces: str = "piece_bpe_32k.model",
    common_pairs: int = 100_000,
    keep_groups: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    and, if kept, groups (see `aligned_documents`).

    The count of an id pair is the number of rows of `docs` that hold it linked. count_sum adds up
    the counts of a document's links; n_best counts the links whose pair is the commonest of its A
    id, ties included. Repeated rows are documents of their own. doc_id is a whole number and may
    be null; other columns, whatever their names, are left out. Whole texts are aligned, one at a
    time in memory. An empty table gives no rows.

    The `common_pairs` commonest pairs are looked up in every task, others by a shuffle.
    """
    aligned = aligned_documents(docs, byte_level, pieces, keep_groups)
    # Written once: row numbers stay with their rows.
    aligned = cut_lineage(aligned.withColumn("row", F.monotonically_increasing_id()))
    counts = pair_counts(aligned)
    links = aligned.select(
        "row", F.explode(F.arrays_zip("pairs", "links")).alias("p")
    ).select("row", F.col("p.pairs").alias("pair"), F.col("p.links").alias("times"))
    common = counts.orderBy(F.desc("documents"), "pair").limit(common_pairs)
    # A fixed number of rows of three values.
    looked_up = links.join(F.broadcast(common), "pair", "left")
    looked_up = cut_lineage(
        looked_up.groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
            F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"),
            F.filter(
                F.collect_list(F.when(F.col("documents").isNull(), F.struct("pair", "times"))),
                lambda x: x.isNotNull(),
            ).alias("rest"),
        )
    )
    rest = (
        looked_up.select("row", F.explode("rest").alias("p"))
        .select("row", "p.pair", "p.times")
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
            F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"),
        )
    )
    sums = (
        looked_up.select("row", "count_sum", "n_best")
        .unionByName(rest)
        .groupBy("row")
        .agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    )
    none = F.lit(0).cast("long")
    return aligned.join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
        *["groups"] * keep_groups,
    )
