"""Packing tokenised documents into sequences by shortest-pack-first over the length histogram.

Documents become pieces of at most `capacity` tokens. The histogram of piece lengths has at most
`capacity` entries, whatever the number of documents, and is all that the packing itself reads:
lengths are placed longest first, each into the emptiest sequences that still have room, and
sequences with equal content are one pattern with a count. The patterns go back to the pieces by
the rank of a piece among those of its length.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import number_rows, prefix_digits, scatter
from .tables import cut_lineage

END_OF_TEXT = 1


class ChunkEncoder:
    """Token ids of texts as little-endian 32-bit words, remembering what each chunk becomes.

    This vocabulary's pre-tokeniser drops white space and never joins across it, so a text's ids
    are its space- and newline-separated chunks' ids in order. A chunk of Latin letters and ASCII
    marks goes straight to the merge model piece by piece; any other goes through the tokenizer.
    The memory is emptied when it holds `limit` chunks or pieces.
    """

    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    MARKS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.limit = limit
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.plain = re.compile(f"([{self.LETTERS}]*)([{self.MARKS}]*)").fullmatch
        # Byte-level vocabularies show printable bytes as themselves, the rest from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.shown = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            spelled = piece if piece.isascii() else "".join(map(self.shown.get, piece.encode()))
            ids = [token.id for token in self.model.tokenize(spelled)]
            found = b"".join(i.to_bytes(4, "little") for i in ids)
            if len(self.pieces) >= self.limit:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        if parts := self.plain(chunk):
            letters, marks = parts.groups()
            found = (self._piece(letters.lower()) if letters else b"") + (
                self._piece(marks) if marks else b""
            )
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            found = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(self.chunks) >= self.limit:
            self.chunks.clear()
        self.chunks[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        known = self.chunks.get
        out = []
        for chunk in text.replace("\n", " ").split(" "):
            found = known(chunk)
            out.append(self._chunk(chunk) if found is None else found)
        return b"".join(out)


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    """One per Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def file_positions(docs: DataFrame, out: str) -> DataFrame:
    """Add `out` to rows read from Parquet files: 0, 1, 2, ... by file name, then row in the file.

    Only a row per file is gathered. A filter after reading leaves gaps, but the order stays.
    """
    placed = docs.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__index"),
    )
    files = placed.groupBy("__file").agg((F.max("__index") + 1).alias("__rows"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        "__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start")
    )
    return (
        placed.join(F.broadcast(starts), "__file")
        .withColumn(out, F.col("__start") + F.col("__index"))
        .drop("__file", "__index", "__start")
    )


def token_pieces(
    docs: DataFrame, path: str, capacity: int, keep_ids: bool = False, order: str | None = None
) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens and, if kept, ids.

    `order` names a column of whole numbers that pieces keep as __position.

    A null text is an empty one. Every document ends with the token END_OF_TEXT, so an empty
    document is one piece of one token. All pieces but a document's last are `capacity` long.
    """
    end = END_OF_TEXT.to_bytes(4, "little")
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            places = batch.column(2).to_pylist() if order else [None] * batch.num_rows
            for doc, text, place in zip(
                batch.column(0).to_pylist(), batch.column(1), places, strict=True
            ):
                ids = encoder.encode(text.as_py() or "") + end
                for at in range(0, len(ids), width):
                    piece = ids[at : at + width]
                    values = (doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                    for column, value in zip(rows, (*values, piece, place), strict=True):
                        column.append(value)
            arrays = [pa.array(rows[0], batch.column(0).type)]
            arrays += [pa.array(column, pa.int64()) for column in rows[1:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                arrays.append(pa.array(rows[5], pa.binary()))
                names.append("ids")
            if order:
                arrays.append(pa.array(rows[6], pa.int64()))
                names.append("__position")
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += (", ids binary" if keep_ids else "") + (", __position long" if order else "")
    place = [F.col(order).cast("long")] if order else []
    return docs.select("doc_id", F.col("text").cast("string"), *place).mapInArrow(cut, schema)


def pack_histogram(
    histogram: Mapping[int, int], capacity: int
) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (sequences, [(length, copies), ...]) that hold every length of the histogram.

    The same as placing single pieces, longest first, each into the emptiest sequence with room
    for it, but over whole groups of equal sequences at a time.
    """
    open_patterns: list[tuple[int, int, int, list[tuple[int, int]]]] = []
    made = 0  # orders patterns of equal room by age

    def keep(room: int, sequences: int, pattern: list[tuple[int, int]]) -> None:
        nonlocal made
        if sequences:
            heapq.heappush(open_patterns, (-room, made, sequences, pattern))
            made += 1

    def extended(pattern, length, copies):
        if not copies:
            return pattern
        if pattern and pattern[-1][0] == length:
            return [*pattern[:-1], (length, pattern[-1][1] + copies)]
        return [*pattern, (length, copies)]

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        while left:
            room = -open_patterns[0][0] if open_patterns else 0
            if room < length:
                each = capacity // length
                full, rest = divmod(left, each)
                keep(capacity - each * length, full, [(length, each)])
                if rest:
                    keep(capacity - rest * length, 1, [(length, rest)])
                break
            _, _, sequences, pattern = heapq.heappop(open_patterns)
            runner_up = -open_patterns[0][0] if open_patterns else 0
            # Copies each sequence takes while it is still the emptiest one with room.
            copies = 1 + (room - max(runner_up, length)) // length
            if left >= copies * sequences:
                keep(room - copies * length, sequences, extended(pattern, length, copies))
                left -= copies * sequences
            else:
                copies, more = divmod(left, sequences)
                keep(room - (copies + 1) * length, more, extended(pattern, length, copies + 1))
                keep(room - copies * length, sequences - more, extended(pattern, length, copies))
                break
    return [(sequences, pattern) for _, _, sequences, pattern in sorted(open_patterns)]


def rank_ranges(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, ...]]:
    """Rows (length, first rank, rank after, first sequence, sequences, offset), ranks by length."""
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for sequences, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            first = next_rank.get(length, 0)
            next_rank[length] = first + copies * sequences
            rows.append((length, first, next_rank[length], sequence, sequences, offset))
            offset += copies * length
        sequence += sequences
    return rows


def place_pieces(pieces: DataFrame, capacity: int, block_rows: int = 50_000) -> DataFrame:
    """Add sequence_id and offset to pieces with doc_id, start and length.

    Pieces of a length are ranked by a scatter of doc_id and start or, if there is a __position, by
    it and start. `pieces` is read several times and should be a written table.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    ranges = rank_ranges(pack_histogram(counts, capacity))
    fields = "struct<first:long,after:long,sequence:long,sequences:long,offset:long>"
    by_length: dict[int, list[tuple[int, ...]]] = {}
    for length, *rest in ranges:
        by_length.setdefault(length, []).append(tuple(rest))
    table = pieces.sparkSession.createDataFrame(
        list(by_length.items()), f"length long, __ranges array<{fields}>"
    )
    if "__position" in pieces.columns:
        order = F.struct("__position", "start")
        block = _position_block(pieces, sum(counts.values()), block_rows)
    else:
        order = scatter(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("start")))
        digits = prefix_digits(sum(counts.values()), block_rows)
        block = F.substring("__order", 1, digits)
    keyed = pieces.withColumn("__order", order).withColumn("__block", block)
    ranked = number_rows(
        keyed, "__rank", ["length"], "__block", [F.col("__order"), F.col("ids_crc32")]
    )
    # One row per length, at most `capacity` of them.
    joined = ranked.join(F.broadcast(table), "length")
    mine = F.filter(
        "__ranges", lambda r: (r["first"] <= F.col("__rank")) & (F.col("__rank") < r["after"])
    )
    inside = F.col("__rank") - F.col("__at.first")
    copy = F.floor(inside / F.col("__at.sequences")).cast("long")
    return (
        joined.withColumn("__at", F.get(mine, F.lit(0)))
        .withColumn("sequence_id", F.col("__at.sequence") + inside % F.col("__at.sequences"))
        .withColumn("offset", F.col("__at.offset") + copy * F.col("length"))
        .drop("__order", "__block", "__rank", "__ranges", "__at")
    )


def _position_block(pieces: DataFrame, rows: int, block_rows: int) -> Column:
    """Ranges of __position that hold about `block_rows` of the `rows` pieces each."""
    last = pieces.agg(F.max("__position")).first()[0] or 0
    return F.floor(F.col("__position") / max(1, (last + 1) * block_rows // max(1, rows))).cast("long")


def in_given_order(placed: DataFrame, block_rows: int = 2_000) -> DataFrame:
    """Number the sequences anew by the __position and start of their first, longest piece.

    `placed` is read several times and should be a written table.
    """
    firsts = placed.where(F.col("offset") == 0).select("sequence_id", "__position", "start")
    firsts = firsts.withColumn("__block", _position_block(placed, placed.count(), block_rows))
    by_place = [F.col("__position"), F.col("start"), F.col("sequence_id")]
    numbers = number_rows(firsts, "__sequence", [], "__block", by_place)
    return placed.join(numbers.select("sequence_id", "__sequence"), "sequence_id").withColumn(
        "sequence_id", F.col("__sequence")
    )


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = 2048,
    keep_ids: bool = False,
    block_rows: int = 50_000,
    order: str | None = None,
) -> DataFrame:
    """One row per piece of every document, with its sequence and its offset there.

    `path` names the vocabulary file, which must be the word-level one that ChunkEncoder is for.
    Repeated rows are packed once each. An empty table gives no rows. Columns other than doc_id
    and text are left out. With `keep_ids`, ids holds the piece's little-endian 32-bit token ids;
    ordered by offset, the pieces of one sequence_id are a training sequence, padded to capacity.

    `order` names a column of whole numbers, not null, that tells the order of documents: pieces of
    a length are then dealt out in that order, and sequences are numbered by their first, longest
    piece. Without it documents are scattered over the sequences.
    """
    pieces = cut_lineage(token_pieces(docs, path or vocabulary_path(), capacity, keep_ids, order))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    placed = place_pieces(pieces, capacity, block_rows)
    if order:
        placed = in_given_order(cut_lineage(placed))
    return placed.select(*columns, *["ids"] * keep_ids)
