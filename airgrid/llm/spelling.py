"""Spelling variants: words one edit apart, found by search schemes over FM-indexes.

A word and its near word agree on the first or on the second half of the searched word, between the
word's end and its middle. So words meet by that half, delimiter included: `front` halves in an
index that reads words forwards, `back` halves in one that reads them backwards; together they are
the two directions of a bidirectional index. In a task the delimited words of a part of the halves
are one text with its suffix order. A search matches its half exactly, symbol by symbol, as an
interval of suffix ranks, extends over the other half with one inserted, deleted or replaced symbol
anywhere in it, and ends at the delimiter; what is left of the interval names the near words.

Halves that very many words share are dealt out as a grid: blocks of indexed words by blocks of
searching words. A task's memory is bounded, and no pairs but the near ones ever exist.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage

_RUN = re.compile("[a-zÀ-ÿ]+")


def _runs(text: str) -> Counter:
    """Maximal runs of a-z, A-Z and U+00C0 to U+00FF, with only A-Z lower-cased."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if len(lowered) < 1 << 20:
        return Counter(_RUN.findall(lowered))
    return Counter(found.group() for found in _RUN.finditer(lowered))


def count_words(
    docs: DataFrame, least_chars: int = 6, least_count: int = 5, drop_one_in: int = 199
) -> DataFrame:
    """word and n: the words of at least `least_chars` symbols that occur at least `least_count`
    times in the whole texts.

    The runs of a document whose crc32 of `<doc_id>:<run>` is divisible by `drop_one_in` lose the
    symbol at that number modulo their length (0: none does). A null text has no words; a null
    doc_id is written as nothing. Repeated rows count each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            words, times = pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())
            totals.clear()
            return pa.RecordBatch.from_arrays([words, times], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for run, times in _runs(text.as_py()).items():
                    if drop_one_in:
                        h = zlib.crc32(run.encode(), start)
                        if h % drop_one_in == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                    if len(run) >= least_chars:
                        totals[run] += times
                if len(totals) > 300_000:
                    yield flushed()
        yield flushed()

    texts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counted = texts.where(F.col("text").isNotNull()).mapInArrow(count, "word string, n long")
    totals = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return totals.where(F.col("n") >= least_count)


class SuffixRanks:
    """The FM-index of words over whole-number symbols from 1 on, 0 being the delimiter.

    Symbols of the transformed text are kept as one sorted array of (symbol, row) numbers, so a
    step of many searches is one binary search of many values. Suffixes are ordered by as many
    symbols as the longest search reads; the order of those that agree on them doesn't matter.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, longest: int):
        """symbols: all words one after another."""
        words = len(lengths)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.zeros(starts[-1] + 1, np.int64)  # a delimiter before, between and behind
        inside = np.ones(len(text), bool)
        inside[starts] = False
        text[inside] = symbols
        order = self._ordered(text, longest)
        self.rows = len(text)
        self.symbols = int(text.max(initial=0)) + 1
        self.before = text[order - 1]  # the text is read as a ring
        self.keys = np.sort(self.before * self.rows + np.arange(self.rows))
        # The word that starts behind the delimiter at a suffix's place.
        word_at = np.full(len(text), -1)
        word_at[starts[:words]] = np.arange(words)
        self.word_of_rank = word_at[order]

    @staticmethod
    def _ordered(text: np.ndarray, longest: int) -> np.ndarray:
        """Places in the order of what is read from them on, by doubling the length compared."""
        order = np.argsort(text, kind="stable")
        rank = np.zeros(len(text), np.int64)
        value, width = text, 1
        while True:
            ordered = value[order]
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            distinct = rank[order[-1]] + 1
            if width >= longest or distinct == len(text):
                return order
            value = rank * distinct + np.roll(rank, -width)
            order = np.argsort(value, kind="stable")
            width *= 2

    def extended(self, low: np.ndarray, high: np.ndarray, symbol) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with one more symbol in front."""
        base = symbol * self.rows
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, symbol) for every symbol but the delimiter that stands before an interval.

        Short intervals are looked through; for long ones all symbols are tried."""
        size = high - low
        short = np.flatnonzero(size <= self.symbols)
        counts = size[short]
        into = np.repeat(np.cumsum(counts) - counts, counts)
        ranks = np.repeat(low[short], counts) + np.arange(counts.sum()) - into
        seen = np.unique(np.repeat(short, counts) * self.symbols + self.before[ranks])
        wide = np.flatnonzero(size > self.symbols)
        tried = (wide[:, None] * self.symbols + np.arange(1, self.symbols)).reshape(-1)
        both = np.concatenate([seen[seen % self.symbols > 0], tried])
        return both // self.symbols, both % self.symbols


def one_edit_matches(
    index: SuffixRanks, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, exact: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) numbers, each once, of indexed words at edit distance one from a query with
    the edit before its last `exact` symbols.

    Query i is symbols[starts[i]:ends[i]]; it is read from its end.
    """
    query = np.arange(len(starts))
    low, high = index.extended(
        np.zeros(len(starts), np.int64), np.full(len(starts), index.rows), np.int64(0)
    )
    place = ends - 1  # of the symbol to be read next
    for done in range(int(exact.max(initial=0))):
        go = np.flatnonzero(done < exact[query])
        low[go], high[go] = index.extended(low[go], high[go], symbols[place[go]])
        place[go] -= 1
        keep = low < high
        query, low, high, place = query[keep], low[keep], high[keep], place[keep]
    # Searches with the error behind them: query, place, interval.
    spent: list[tuple[np.ndarray, ...]] = []
    while query.size:
        more = place >= starts[query]
        wanted = np.where(more, symbols[np.maximum(place, 0)], 0)
        following = place - 1 >= starts[query]
        repeated = following & (symbols[np.maximum(place - 1, 0)] == wanted)
        # One symbol of the query is missing in the word; of equal neighbours, the last one read.
        gone = np.flatnonzero(more & ~repeated)
        spent.append((query[gone], place[gone] - 1, low[gone], high[gone]))
        parent, symbol = index.children(low, high)
        c_low, c_high = index.extended(low[parent], high[parent], symbol)
        full = c_low < c_high
        parent, symbol, c_low, c_high = (x[full] for x in (parent, symbol, c_low, c_high))
        same = symbol == wanted[parent]
        other = ~same
        # One more symbol in the word; one that equals the next is found as one behind it.
        spent.append((query[parent[other]], place[parent[other]], c_low[other], c_high[other]))
        swap = other & more[parent]
        spent.append((query[parent[swap]], place[parent[swap]] - 1, c_low[swap], c_high[swap]))
        step = parent[same]
        query, place, low, high = query[step], place[step] - 1, c_low[same], c_high[same]
    query, place, low, high = (np.concatenate([s[i] for s in spent] or [[]]).astype(np.int64) for i in range(4))
    found_query, found_word = [], []
    while query.size:
        more = place >= starts[query]
        wanted = np.where(more, symbols[np.maximum(place, 0)], 0)
        low, high = index.extended(low, high, wanted)
        ended = ~more & (low < high)
        # Words are distinct, so a whole word's interval is one rank wide. No word is empty, but
        # the delimiters at both ends of the ring look like an empty one, with the number -1.
        word = index.word_of_rank[low[ended]]
        found_query.append(query[ended][word >= 0])
        found_word.append(word[word >= 0])
        go = more & (low < high)
        query, place, low, high = query[go], place[go] - 1, low[go], high[go]
    pairs = np.stack([np.concatenate(x or [[]]).astype(np.int64) for x in (found_query, found_word)], 1)
    pairs = np.unique(pairs, axis=0)
    return pairs[:, 0], pairs[:, 1]


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32).astype(np.int64), lengths


def _search(slice_words: int) -> Callable[[pa.Table], pa.Table]:
    def search(part: pa.Table) -> pa.Table:
        """Near words of one side and part of the halves: word, near, near_n."""
        words = part.column("word").to_pylist()
        if words and part.column("side")[0].as_py() == "front":
            words = [word[::-1] for word in words]
        asks = part.column("searches").to_numpy(zero_copy_only=False).astype(bool)
        cells = part.column("cell").to_numpy(zero_copy_only=False)
        counts, halves = part.column("n").to_numpy(), part.column("chars").to_numpy()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        # A cell of a hot half has blocks of its own; all other halves of a part share an index.
        for cell in np.unique(cells):
            indexed, asked = np.flatnonzero(~asks & (cells == cell)), np.flatnonzero(asks & (cells == cell))
            first: dict[str, int] = {}
            for i in indexed:
                first.setdefault(words[i], i)
            if len(first) < 2 and cell == "":
                continue
            known = np.fromiter(first.values(), np.int64, len(first))
            symbols, lengths = _symbols(list(first))
            q_symbols, q_lengths = _symbols([words[i] for i in asked])
            used = np.unique(np.concatenate([symbols, q_symbols]))
            longest = int(max(lengths.max(initial=0), q_lengths.max(initial=0))) + 3
            index = SuffixRanks(np.searchsorted(used, symbols) + 1, lengths, longest)
            q_symbols = np.searchsorted(used, q_symbols) + 1
            ends = np.cumsum(q_lengths)
            for at in range(0, len(asked), slice_words):
                s = slice(at, at + slice_words)
                query, word = one_edit_matches(
                    index, q_symbols, (ends - q_lengths)[s], ends[s], halves[asked[s]]
                )
                out.append((asked[s][query], known[word]))
        query, near = (np.concatenate([x[i] for x in out] or [[]]).astype(np.int64) for i in (0, 1))
        spelled = part.column("word")
        return pa.Table.from_arrays(
            [spelled.take(pa.array(query)), spelled.take(pa.array(near)), pa.array(counts[near], pa.int64())],
            ["word", "near", "near_n"],
        )

    return search


def _halves(words: DataFrame) -> DataFrame:
    """side, half, chars, word, n, searches: the half that each word searches with, and the halves
    of words one shorter, equal and one longer by which it can be found."""
    length = F.length("word")
    sides = F.explode(F.array(F.lit("front"), F.lit("back"))).alias("side")

    def exact(size: Column) -> Column:
        front = F.floor(size / 2)
        return F.when(F.col("side") == "front", front).otherwise(size - front).cast("int")

    asked = words.select("word", "n", sides).select(
        "*", F.lit(True).alias("searches"), exact(length).alias("chars")
    )
    found = words.select("word", "n", sides).select(
        "*",
        F.lit(False).alias("searches"),
        F.explode(F.array_distinct(F.array(*(exact(length + d) for d in (-1, 0, 1))))).alias("chars"),
    )
    whole = F.when(F.col("side") == "front", F.substring("word", F.lit(1), F.col("chars"))).otherwise(
        F.substring("word", length - F.col("chars") + 1, F.col("chars"))
    )
    return asked.unionByName(found.where(F.col("chars") <= length)).withColumn("half", whole)


def near_words(words: DataFrame, part_words: int = 20_000) -> DataFrame:
    """word, near, near_n: all pairs, both ways round, of different words at edit distance one.

    `words` has distinct word, at least one symbol, and n; it should be a written table. A part
    holds about `part_words` entries, and a half with more is dealt out as blocks of that size.
    """
    entries = _halves(words)
    blocks = lambda kind: F.ceil(F.count_if(kind) / part_words).cast("int")
    hot = (
        entries.groupBy("side", "half")
        .agg(blocks(~F.col("searches")).alias("across"), blocks(F.col("searches")).alias("down"))
        .where((F.col("across") > 1) | (F.col("down") > 1))
    )
    parts = max(1, -(-6 * words.count() // part_words))
    dealt = entries.join(hot, ["side", "half"], "left")
    up_to = lambda size: F.sequence(F.lit(0), F.greatest(size, F.lit(1)) - 1)
    own = lambda size: F.array(F.pmod(F.xxhash64("word"), F.greatest(size, F.lit(1))).cast("int"))
    searches = F.col("searches")
    dealt = dealt.withColumn(
        "i", F.explode(F.when(searches, up_to(F.col("across"))).otherwise(own(F.col("across"))))
    ).withColumn("j", F.explode(F.when(searches, own(F.col("down"))).otherwise(up_to(F.col("down")))))
    is_hot = F.col("across").isNotNull()
    cell = F.when(is_hot, F.concat_ws(":", "half", "i", "j")).otherwise("")
    part = F.pmod(F.xxhash64("side", "half", "i", "j"), F.lit(parts)).cast("int")
    part = F.when(is_hot, -1 - part).otherwise(part)  # hot cells don't join the other halves
    return (
        dealt.select("side", "word", "n", "chars", "searches", cell.alias("cell"), part.alias("part"))
        .groupBy("side", "part")
        .applyInArrow(_search(part_words), "word string, near string, near_n long")
    )


def follow_forms(forms: DataFrame) -> DataFrame:
    """word and root: the end of each word's chain of forms, by doubling the steps.

    forms(word, form) has every word once; form may be null. Forms must be more frequent than
    their words, so that chains end. Every round is written; only a count is collected.
    """
    at = cut_lineage(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        ahead = at.where(F.col("word") != F.col("root"))
        ahead = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(ahead, "root", "left").select(
            "word",
            F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved"),
        )
        at = cut_lineage(moved)
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def group_spellings(
    docs: DataFrame,
    least_chars: int = 6,
    least_count: int = 5,
    times_as_frequent: int = 5,
    drop_one_in: int = 199,
    part_words: int = 20_000,
) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word that `count_words` finds.

    A word's form is its most frequent near word (ties: the least in code-point order) if that is
    at least `times_as_frequent` as frequent, else null; root is the last word of its chain of
    forms, the word itself without any. n_near counts its near words. Without words no rows come
    back. Only doc_id and text are read, so other columns, whatever their names, do no harm.
    """
    words = cut_lineage(count_words(docs, least_chars, least_count, drop_one_in))
    first = F.min(F.struct(-F.col("near_n"), F.col("near").alias("near")))
    near = (
        near_words(words, part_words)
        .repartition("word")  # both aggregations below work on these partitions
        .groupBy("word", "near")
        .agg(F.max("near_n").alias("near_n"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), first.alias("first"))
        .select("word", "n_near", "first.near", (-F.col("first.col1")).alias("near_n"))
    )
    enough = F.col("near_n") >= times_as_frequent * F.col("n")
    grouped = cut_lineage(
        words.join(near, "word", "left").select(
            "word",
            F.when(enough, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("near_n")).alias("form_n"),
        )
    )
    roots = follow_forms(grouped)
    return grouped.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
