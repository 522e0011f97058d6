"""Document fingerprints by locally consistent parsing.

A text is a sequence of symbols (code points). One round of parsing:

1. Runs of one symbol become a single symbol, so that neighbours differ.
2. Deterministic coin tossing: each symbol is replaced by twice the lowest bit place in which it
   differs from its left neighbour, plus its own bit there. Neighbours still differ, and after four
   repetitions at most six labels are left.
3. A phrase starts at every local maximum of the labels; its name is a hash of its symbols.

The names are the symbols of the next round. Every cut depends on a few neighbouring symbols only,
so equal substrings are cut alike, whatever stands before them, except near their ends: after
`rounds` rounds they share all names of inner phrases. The fingerprint is a one-permutation MinHash
of a text's set of top-level names; the share of equal fields estimates the share of common phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut_lineage

FIELDS = 64
_EMPTY = 0xFFFF
_CHUNK = 500_000  # code points parsed at a time

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _toss_table(bits: int) -> np.ndarray:
    """New label by (left label, own label), for labels of `bits` bits."""
    left, own = np.divmod(np.arange(1 << 2 * bits), 1 << bits)
    differ = left ^ own
    place = np.where(differ > 0, np.log2(np.maximum(differ & -differ, 1)).astype(int), 0)
    return (2 * place + ((own >> place) & 1)).astype(np.uint8)


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Four rounds of coin tossing; `first` marks each text's first symbol."""
    differ = symbols.copy()
    differ[1:] ^= symbols[:-1]
    # A first symbol has no left neighbour: its lowest bit decides, which differs from the
    # second symbol's label too.
    differ[first] = 1
    lowest = differ & (~differ + np.uint64(1))
    place = np.frexp(lowest.astype(np.float64))[1] - 1
    own = (symbols >> place.astype(np.uint64)) & np.uint64(1)
    labels = (2 * place + own.astype(np.int64)).astype(np.uint8)
    for bits in (7, 4, 3):  # labels below 128, 14, 8; then below 6
        tossed = np.empty_like(labels)
        pair = (labels[:-1].astype(np.uint16) << np.uint16(bits)) | labels[1:]
        tossed[1:] = _toss_table(bits)[pair]
        tossed[first] = labels[first] & 1
        labels = tossed
    return labels


def _round(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and owners of the phrases of one round over the texts' concatenated symbols."""
    if not len(symbols):
        return symbols, owner
    start = np.empty(len(symbols), bool)
    start[0] = True
    np.not_equal(symbols[1:], symbols[:-1], out=start[1:])
    start[1:] |= owner[1:] != owner[:-1]
    at = np.flatnonzero(start)
    length = np.diff(np.append(at, len(symbols)))
    symbols, owner = symbols[at], owner[at]
    runs = length > 1
    symbols[runs] = _mix(symbols[runs] * _A + length[runs].astype(np.uint64))
    first = np.empty(len(symbols), bool)
    first[0] = True
    np.not_equal(owner[1:], owner[:-1], out=first[1:])
    labels = _labels(symbols, np.flatnonzero(first))
    higher = np.zeros(len(symbols), bool)
    rises = labels[1:] > labels[:-1]
    higher[1:-1] = rises[:-1] & ~rises[1:]
    # A text's last symbol starts no phrase: what follows it is another text.
    last = np.append(first[1:], True)
    cut = np.flatnonzero(first | (higher & ~last))
    size = np.diff(np.append(cut, len(symbols)))
    place = np.arange(len(symbols)) - np.repeat(cut, size)
    spread = _mix((symbols + place.astype(np.uint64) * _A) * _C)
    names = _mix(np.add.reduceat(spread, cut) + size.astype(np.uint64))
    return names, owner[cut]


def fingerprint_fields(texts: list[str], rounds: int) -> np.ndarray:
    """One row of FIELDS 16-bit values per text; fields without a phrase hold 65535."""
    out = np.full((len(texts), FIELDS), _EMPTY, np.uint16)
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= _CHUNK):
            total += len(texts[end])
            end += 1
        joined = "".join(texts[at:end]).encode("utf-32-le")
        names = np.frombuffer(joined, np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(at, end), [len(t) for t in texts[at:end]])
        for _ in range(rounds):
            names, owner = _round(names, owner)
        # The field of a name, and its value among the names of that field.
        names = _mix(names + _A)
        field = owner * FIELDS + (names & np.uint64(FIELDS - 1)).astype(np.int64)
        value = ((names >> np.uint64(6)) % np.uint64(_EMPTY)).astype(np.uint16)
        np.minimum.at(out.reshape(-1), field, value)
        at = end
    return out


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal fields among those that either fingerprint has; 1 for two empty ones."""
    used = ((left != _EMPTY) | (right != _EMPTY)).sum(-1)
    equal = ((left == right) & (left != _EMPTY)).sum(-1)
    return np.where(used > 0, equal / np.maximum(used, 1), 1.0)


def spelled(fields: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in fields.astype(">u2")]


def unspelled(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2").astype(np.uint16)


def fingerprint_documents(docs: DataFrame, rounds: int = 3) -> DataFrame:
    """`docs` with a `fingerprint` of the whole text; a null text counts as empty.

    Equal texts have equal fingerprints. A `fingerprint` of the input is replaced.
    """
    docs = docs.drop("fingerprint")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            made = pa.array(spelled(fingerprint_fields(texts, rounds)), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], made], [*batch.schema.names[:-1], "fingerprint"]
            )

    schema = docs.schema.add("fingerprint", "string")
    return docs.select("*", F.col("text").cast("string").alias("__text")).mapInArrow(add, schema)


def edited(text: str, following: str) -> str:
    """`text` with its last half (rounded down) replaced by as many first code points of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _digest(texts: list[str]) -> list[str]:
    import hashlib

    return [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def _measured(docs: list, texts: list[str], nexts: list[str], rounds: int) -> dict[str, list]:
    changed = [edited(t, f) for t, f in zip(texts, nexts, strict=True)]
    own, new = fingerprint_fields(texts, rounds), fingerprint_fields(changed, rounds)
    after = fingerprint_fields(nexts[-1:], rounds) if nexts else own[:0]
    following = np.concatenate([own[1:], after])
    return {
        "doc_id": docs,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": _digest(changed),
        "fingerprint": spelled(own),
        "edited_fingerprint": spelled(new),
        "near_edited": likeness(own, new),
        "near_next": likeness(own, following),
    }


def fingerprint_edits(docs: DataFrame, rounds: int = 3) -> DataFrame:
    """Fingerprints of every text and of the text edited with its successor, and their likeness.

    Successors go by descending doc_id, null ids last, then by the text's hash; the last one's is
    the first of all. Of several rows with one id and text, each has the next as successor. With a
    single document, that document is its own successor. Null texts count as empty.

    Rows are range-partitioned once and each partition is walked in order. The first and last text
    of every partition are set aside, and the few pairs across partitions are made from those.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    results = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    columns = [c.split()[0] for c in results.split(", ")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    order: list[Column] = [F.desc_nulls_last("doc_id"), F.asc("__hash"), F.asc("__row")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", text.alias("text"))
        # The row's number only deals equal rows over partitions.
        .select("*", F.xxhash64("text").alias("__hash"), F.monotonically_increasing_id().alias("__row"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )

    def emitted(found: dict[str, list], edge: str, part: int, text: list[str | None]) -> pa.RecordBatch:
        size = len(found["doc_id"])
        arrays = [found["doc_id"], *(pa.array(found[c]) for c in columns[1:])]
        arrays += [pa.array([edge] * size), pa.array([part] * size, pa.int32()), pa.array(text, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, [*columns, "edge", "part", "text"])

    def blank(doc: pa.Array) -> dict[str, list]:
        return {c: pa.nulls(1, t) for c, t in zip(columns, blank_types, strict=True)} | {"doc_id": doc}

    blank_types = [pa.null(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_id = held_text = part = None
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                ids, texts = rows.column(0), rows.column(1).to_pylist()
                if held_id is None:
                    part = rows.column(2)[0].as_py()
                    yield emitted(blank(ids.slice(0, 1)), "first", part, texts[:1])
                else:
                    ids = pa.concat_arrays([held_id, ids])
                    texts.insert(0, held_text)
                held_id, held_text = ids.slice(len(ids) - 1), texts[-1]
                if len(texts) > 1:
                    found = _measured(ids.slice(0, len(ids) - 1), texts[:-1], texts[1:], rounds)
                    yield emitted(found, "", part, [None] * (len(texts) - 1))
        if held_id is not None:
            yield emitted(blank(held_id), "last", part, [held_text])

    walked = cut_lineage(
        ordered.mapInArrow(walk, f"{results}, edge string, part int, text string")
    )
    # Two rows per partition: number the partitions that have rows, and meet the next one's first.
    firsts = walked.where(F.col("edge") == "first").select("part", F.col("text").alias("following"))
    lasts = walked.where(F.col("edge") == "last").select("part", "doc_id", "text")
    parts_used = firsts.select("part")
    all_parts = Window.partitionBy(F.lit(0))
    after = F.coalesce(F.lead("part").over(all_parts.orderBy("part")), F.min("part").over(all_parts))
    links = parts_used.select("part", after.alias("next_part"))
    pairs = lasts.join(links, "part").join(
        firsts.withColumnRenamed("part", "next_part"), "next_part"
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, following = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                found = _measured(batch.column(0).slice(i, 1), [own], [following], rounds)
                arrays = [found["doc_id"], *(pa.array(found[c]) for c in columns[1:])]
                yield pa.RecordBatch.from_arrays(arrays, columns)

    closed = pairs.select("doc_id", "text", "following").mapInArrow(close, results)
    return walked.where(F.col("edge") == "").select(*columns).union(closed)
