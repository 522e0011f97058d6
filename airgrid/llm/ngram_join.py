"""All pairs of documents whose sets of word n-grams have a Jaccard similarity of at least 0.8.

1. Each text becomes its set of hashed n-grams and a MinHash signature. Texts with equal sets are
   one class; everything below works on classes.
2. Candidates: signatures are cut into bands; classes that agree on a whole band are in a bucket.
   A pair exactly at the threshold shares no bucket with a probability of (1 - t**rows)**bands,
   3e-6 at the defaults; more similar pairs with a smaller one.
3. Bayesian pruning: the two signatures are compared a few values at a time. With m agreements
   among n values and a uniform prior, the similarity is distributed as Beta(m + 1, n - m + 1);
   the pair is dropped as soon as the probability of reaching the threshold falls below
   `tolerance`. Most candidates end after the first values.
4. The rest is verified exactly on the n-gram sets, inside families: the components of the pairs
   left. In a family every pair is tested, in square blocks of bounded size dealt over tasks, so
   that no pair is ever a row. Buckets of more than `hot` classes, which only arise from many
   copies of one text, do not emit pairs either but join a family as a whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .tables import cut_lineage

_WORD = re.compile(r"\w+")
_STEP = 16  # signature values compared between two looks at the posterior
_PIECE = 1_000_000  # words hashed at a time


class _WordHashes(dict):
    """64-bit hashes of words; emptied when it holds a million."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of lower-cased words (runs of \\w).

    A text of fewer than n words, but at least one, is a single shorter n-gram.
    """
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    grams = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        grams = _mix(grams ^ hashes[i : len(hashes) - size + 1 + i]) + np.uint64(i)
    return np.unique(grams)


def _multipliers(count: int) -> np.ndarray:
    rng = np.random.default_rng(20)
    return rng.integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1)


def signature(grams: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least of each hash function over the set, as 32-bit values."""
    out = np.empty(len(multipliers), np.uint32)
    for i, factor in enumerate(multipliers):
        out[i] = (grams * factor).min() >> np.uint64(32)
    return out


def _set_id(grams: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(grams.tobytes()) - 2**63


def _text_id(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode(), seed=1) - 2**63


def least_agreements(values: int, threshold: float, tolerance: float) -> np.ndarray:
    """For n = 0..values: the fewest agreements among n values at which a pair is not dropped.

    P(similarity >= t | m of n) is the tail of Beta(m + 1, n - m + 1), which equals the chance of
    at most m successes in n + 1 trials of probability t.
    """
    least = np.zeros(values + 1, np.int64)
    for n in range(values + 1):
        tail, m = 0.0, -1
        while tail < tolerance and m <= n:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least[n] = m
    return least


def document_sets(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_hash, set_id (null for null texts), signature and band hashes of every document."""
    factors = _multipliers(bands * rows)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, signatures, hashes = [], [], []
            for text in batch.column(2):
                text = text.as_py()
                grams = ngram_set(text, n)
                if not len(grams):
                    # No n-grams to compare: only an equal text is like it, and nothing like null.
                    ids.append(None if text is None else _text_id(text))
                    signatures.append(None)
                    hashes.append(None)
                    continue
                values = signature(grams, factors)
                folded = np.arange(bands, dtype=np.uint64)
                for part in values.reshape(bands, rows).T.astype(np.uint64):
                    folded = _mix(folded * np.uint64(31) + part)
                ids.append(_set_id(grams))
                signatures.append(values.tobytes())
                hashes.append(folded.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(ids, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "set_id", "signature", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, set_id long, signature binary, bands array<long>"
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text).mapInArrow(sets, schema)


def _likely(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which pairs of signature rows survive the Bayesian comparison."""
    alive = np.arange(len(left))
    agreed = np.zeros(len(left), np.int64)
    for at in range(0, left.shape[1], _STEP):
        part = slice(at, min(at + _STEP, left.shape[1]))
        agreed[alive] += (left[alive, part] == right[alive, part]).sum(1)
        alive = alive[agreed[alive] >= least[part.stop]]
    return alive


def candidate_edges(
    classes: DataFrame, hot: int, threshold: float, tolerance: float, values: int
) -> DataFrame:
    """Edges (a, b) of classes(set_id, signature, bands): pairs that survive the pruning, and a
    star for every bucket of more than `hot` classes."""
    least = least_agreements(values, threshold, tolerance)
    members = classes.select("set_id", F.explode("bands").alias("bucket"))
    sizes = (
        members.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("set_id").alias("low"))
        .where("n > 1")
    )
    filled = cut_lineage(members.join(sizes, "bucket"))
    stars = filled.where((F.col("n") > hot) & (F.col("set_id") != F.col("low")))
    small = filled.where(F.col("n") <= hot)
    left = small.select("bucket", F.col("set_id").alias("a"))
    right = small.select("bucket", F.col("set_id").alias("b"))
    pairs = left.join(right, "bucket").where("a < b").select("a", "b").distinct()
    known = classes.select("set_id", "signature")
    pairs = pairs.join(
        known.select(F.col("set_id").alias("a"), F.col("signature").alias("x")), "a"
    ).join(known.select(F.col("set_id").alias("b"), F.col("signature").alias("y")), "b")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [
                np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, values)
                for column in (batch.column(2), batch.column(3))
            ]
            kept = pa.array(_likely(*sides, least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept)], ["a", "b"]
            )

    likely = pairs.select("a", "b", "x", "y").mapInArrow(prune, "a long, b long")
    return likely.union(stars.select(F.col("set_id").alias("a"), F.col("low").alias("b")))


def _block_links(
    sets: list[np.ndarray],
    first: np.ndarray,
    second: np.ndarray,
    factors: np.ndarray,
    threshold: float,
    least: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j), i in `first` and j in `second`, i before j where both hold them."""
    signatures = np.stack([signature(s, factors) for s in sets])
    agreed = np.zeros((len(first), len(second)), np.int64)
    alive = first[:, None] < second[None, :] if first is second else np.ones_like(agreed, bool)
    for at in range(0, len(factors), _STEP):
        for k in range(at, min(at + _STEP, len(factors))):
            agreed += signatures[first, k][:, None] == signatures[second, k][None, :]
        alive &= agreed >= least[min(at + _STEP, len(factors))]
        if not alive.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
    # Common n-grams by products of 0/1 matrices, over as many n-grams at a time as fit.
    grams, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(where, minlength=len(grams)) > 1
    column = np.cumsum(shared) - 1
    owner, where = owner[shared[where]], column[where[shared[where]]]
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    common = np.zeros((len(first), len(second)), np.float32)
    width = 4096
    for at in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(where, (at, at + width))
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[owner[low:high], where[low:high] - at] = 1
        common += matrix[first] @ matrix[second].T
    sizes = np.array([len(s) for s in sets], np.float64)
    together = sizes[first][:, None] + sizes[second][None, :]
    # common / (together - common) >= threshold, without rounding for 4/5.
    linked = alive & (common * (1 + threshold) >= threshold * together - 1e-9 * together)
    i, j = np.nonzero(linked)
    return first[i], second[j]


def _roots(count: int, pairs: tuple[np.ndarray, np.ndarray]) -> list[int]:
    root = list(range(count))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*(p.tolist() for p in pairs), strict=True):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def verified_links(
    members: DataFrame, n: int, values: int, threshold: float, tolerance: float, block: int
) -> DataFrame:
    """Exact links inside families(set_id, family, size, copies, text): set_id, links, linked_to.

    `size` is the family's number of classes. A family is dealt into chunks of about `block` classes, and every two chunks meet in one task.
    One row per class and block with the documents it is linked to there (links) and the least
    class it is connected with there (linked_to).
    """
    least = least_agreements(values, threshold, tolerance)
    factors = _multipliers(values)
    chunks = F.ceil(F.col("size") / block).cast("int")
    dealt = (
        members.withColumn("chunks", chunks)
        .withColumn("chunk", F.pmod(F.xxhash64("set_id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "family",
            F.least("chunk", "other").alias("low"),
            F.greatest("chunk", "other").alias("high"),
            "chunk",
            "set_id",
            "copies",
            "text",
        )
    )

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, low, high = key
        rows = rows.sort_values("set_id").drop_duplicates("set_id")
        sets = [ngram_set(text, n) for text in rows["text"]]
        chunk = rows["chunk"].to_numpy()
        first = np.flatnonzero(chunk == low)
        second = first if low == high else np.flatnonzero(chunk == high)
        i, j = _block_links(sets, first, second, factors, threshold, least)
        copies = rows["copies"].to_numpy()
        found = np.zeros(len(rows), np.int64)
        np.add.at(found, i, copies[j])
        np.add.at(found, j, copies[i])
        ids = rows["set_id"].to_numpy()
        linked = pd.DataFrame(
            {"set_id": ids, "links": found, "linked_to": ids[_roots(len(rows), (i, j))]}
        )
        return linked[found > 0]

    return dealt.groupBy("family", "low", "high").applyInPandas(
        links, "set_id long, links long, linked_to long"
    )


def similar_documents(
    docs: DataFrame,
    n: int = 5,
    threshold: float = 0.8,
    bands: int = 24,
    rows: int = 4,
    tolerance: float = 1e-6,
    hot: int = 32,
    block: int = 256,
) -> DataFrame:
    """One row per document: doc_id, text_hash, set_id, group_id, class_id and n_links.

    Documents that a chain of links connects share a group_id. n_links is the number of other documents with a similarity of at least `threshold`; copies
    with an equal set count. class_id is the least doc_id of the group. A text without words is only
    linked to equal texts. Null texts have no links, no set_id, no group_id, and their own doc_id as
    class_id. Repeated rows are documents of their own and link to each other. Null ids
    take part and are never a class_id unless a whole class has none.
    """
    sets = cut_lineage(document_sets(docs, n, bands, rows))
    with_text = sets.where(F.col("set_id").isNotNull())
    classes = cut_lineage(
        with_text.groupBy("set_id").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("doc_id").alias("least_id"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        )
    )
    edges = candidate_edges(classes, hot, threshold, tolerance, bands * rows)
    families = components(edges).select(
        F.col("node").alias("set_id"), F.col("component").alias("family")
    )
    sizes = families.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    families = families.join(sizes, "family")
    # The text of one document of each class that has a candidate; texts are never dealt by family.
    wanted = families.join(classes.select("set_id", "copies", "least_id"), "set_id")
    texts = docs.select(F.col("doc_id").alias("least_id"), F.col("text").cast("string"))
    found = wanted.join(texts, wanted["least_id"].eqNullSafe(texts["least_id"])).select(
        "set_id", "family", "size", "copies", "text"
    )
    members = _of_their_set(found, n)
    linked = cut_lineage(
        verified_links(members, n, bands * rows, threshold, tolerance, block)
    )
    groups = components(linked.select(F.col("set_id").alias("a"), F.col("linked_to").alias("b")))
    groups = groups.select(F.col("node").alias("set_id"), F.col("component").alias("group"))
    named = classes.select("set_id", "copies", "least_id").join(groups, "set_id", "left")
    named = named.join(
        linked.groupBy("set_id").agg(F.sum("links").alias("links")), "set_id", "left"
    ).withColumn("group", F.coalesce("group", "set_id"))
    least = named.groupBy("group").agg(F.min("least_id").alias("class_id"))
    by_set = named.join(least, "group").select(
        "set_id",
        F.col("group").alias("group_id"),
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return (
        sets.select("doc_id", "text_hash", "set_id")
        .join(by_set, "set_id", "left")
        .select(
            "doc_id",
            "text_hash",
            "set_id",
            "group_id",
            F.when(F.col("set_id").isNull(), F.col("doc_id"))
            .otherwise(F.col("class_id"))
            .alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def _of_their_set(found: DataFrame, n: int) -> DataFrame:
    """Rows whose text has the n-grams of its set_id; ids shared by several texts bring others."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(4)
            fits = [
                _set_id(grams) == i if len(grams := ngram_set(t.as_py(), n)) else False
                for i, t in zip(ids, texts, strict=True)
            ]
            yield batch.filter(pa.array(fits))

    return found.mapInArrow(check, found.schema)


def one_of_each(docs: DataFrame, similar: DataFrame) -> DataFrame:
    """`docs` without all but one document of each group of `similar`: the one with the least
    doc_id (null ids last) and, where texts share that id, the least hash. Of repeated rows one
    stays. Documents with a null text all stay."""

    def named(column: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))

    me = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    grouped = similar.where(F.col("group_id").isNotNull()).groupBy("group_id")
    first = grouped.agg(F.min(me).alias("first")).select("first.*", F.lit(True).alias("__once"))
    null = similar.where(F.col("group_id").isNull()).select("doc_id", "text_hash").distinct()
    kept = first.drop("last").unionByName(null.withColumn("__once", F.lit(False)))
    kept = kept.select(named("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__once")
    keyed = docs.withColumns(
        {"__id": named("doc_id"), "__hash": F.xxhash64(F.col("text").cast("string"))}
    )
    joined = keyed.join(kept, ["__id", "__hash"])
    copy = F.row_number().over(Window.partitionBy("__id", "__hash").orderBy(F.lit(0)))
    return joined.withColumn("__copy", copy).where((F.col("__copy") == 1) | ~F.col("__once")).select(
        *docs.columns
    )
