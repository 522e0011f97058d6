"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Grades 0 < 1 < ... < K share one weight vector; grade k or more has probability
sigmoid(w . x - cut_k) with rising cuts. The expected severity is the sum of those probabilities.

Features are words and their first four and five letters (which carry compounds and inflected
forms of one stem), each as log(1 + count). The vocabulary and the weights are fitted on a bounded
sample of the labelled documents; every document is scored on its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage

_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in (4, 5) if len(word) > k)]


@dataclass(frozen=True)
class SeverityModel:
    """Feature weights and the rising cuts between grades."""

    weights: dict[str, float]
    cuts: tuple[float, ...]

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row per score."""
        return _sigmoid(scores[:, None] - np.array(self.cuts)[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(
    rows: np.ndarray,
    columns: np.ndarray,
    values: np.ndarray,
    grades: np.ndarray,
    width: int,
    ridge: float = 1e-5,
    steps: int = 400,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of the proportional-odds model on a sparse matrix in triplets.

    Full-batch gradient steps with momentum and per-coordinate scaling; cuts are kept rising by
    fitting the logarithms of their differences.
    """
    top = int(grades.max(initial=1))
    weights = np.zeros(width)
    # Start at the cuts that give every grade its share of the sample.
    shares = [np.clip((grades >= k).mean() if len(grades) else 0.5, 0.01, 0.99) for k in range(1, top + 1)]
    cuts = np.array([np.log((1 - s) / s) for s in shares])
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.05))])
    first, second = np.zeros(width + top), np.zeros(width + top)
    n = max(len(grades), 1)
    index = np.arange(len(grades))
    for step in range(1, steps + 1):
        gaps = np.exp(free[1:])
        cuts = free[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        scores = np.bincount(rows, values * weights[columns], minlength=len(grades))
        above = np.ones((len(grades), top + 2))
        above[:, -1] = 0
        above[:, 1:-1] = _sigmoid(scores[:, None] - cuts)
        slope = above * (1 - above)  # zero at both ends
        chance = np.maximum(above[index, grades] - above[index, grades + 1], 1e-12)
        by_score = -(slope[index, grades] - slope[index, grades + 1]) / chance / n
        gradient = np.zeros(width + top)
        gradient[:width] = np.bincount(columns, values * by_score[rows], minlength=width)
        gradient[:width] += ridge * weights
        by_cut = np.zeros((len(grades), top + 2))
        by_cut[index, grades] += slope[index, grades] / chance / n
        by_cut[index, grades + 1] -= slope[index, grades + 1] / chance / n
        by_cut = by_cut[:, 1:-1].sum(0)
        gradient[width] = by_cut.sum()
        gradient[width + 1 :] = [gaps[k] * by_cut[k + 1 :].sum() for k in range(top - 1)]
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        weights -= move[:width]
        free -= move[width:]
    cuts = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    return weights, cuts


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """text and toxic (0/1) of at most `sample_rows` labelled documents, equal texts once.

    Labels without an id or a mark are left out; several labels of one document count as toxic if
    any is. The sample is the ids with the least hashes.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # At most sample_rows pairs of numbers.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return (
        joined.where(F.col("text").isNotNull())
        .groupBy(F.xxhash64("text").alias("h"))
        .agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
        .select("h", "text", "toxic")
    )


def _counted(text: str) -> Counter:
    found: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for feature in features_of(word):
            found[feature] += n
    return found


def vocabulary(sample: DataFrame, size: int, min_docs: int, least_ratio: float) -> DataFrame:
    """The `size` features of sample(text, toxic) that speak most for toxicity: feature, ratio.

    ratio is the logarithm of the (smoothed) rates in toxic and other documents, and a feature's
    weight is ratio times its toxic documents. Only features with at least `min_docs` of those and
    a ratio of `least_ratio` count: common words differ by chance in a small sample, and the many
    words of an otherwise clean document must not speak against the toxic ones.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                marked[toxic.as_py() > 0].update(_counted(text.as_py()).keys())
            names = list(marked[0] | marked[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([marked[0][f] for f in names], pa.int64()),
                    pa.array([marked[1][f] for f in names], pa.int64()),
                ],
                ["feature", "other", "toxic"],
            )

    counts = sample.select("text", "toxic").mapInArrow(
        count, "feature string, other long, toxic long"
    )
    totals = sample.agg(
        F.sum(1 - F.col("toxic")).alias("all_other"), F.sum("toxic").alias("all_toxic")
    )
    smooth = 0.5
    in_toxic = (F.col("toxic") + smooth) / (F.col("all_toxic") + 2 * smooth)
    in_other = (F.col("other") + smooth) / (F.col("all_other") + 2 * smooth)
    ratio = F.log(in_toxic / in_other)
    weight = F.col("toxic") * ratio
    return (
        counts.groupBy("feature")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= min_docs)
        .join(F.broadcast(totals))  # one row
        .select("feature", ratio.alias("ratio"), weight.alias("weight"))
        .where(F.col("ratio") >= least_ratio)
        .orderBy(F.desc("weight"), "feature")
        .limit(size)
        .select("feature", "ratio")
    )


def fit_severity(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 20_000,
    size: int = 2048,
    min_docs: int = 3,
    least_ratio: float = 1.5,
    marker_ratio: float = 3.0,
) -> SeverityModel:
    """Fit grades 0 (not toxic), 1 and 2 (toxic, with fewer or more marker words) to 0/1 marks.

    A marker is a feature at least exp(marker_ratio) times as frequent in toxic documents; grade 2
    has more marker occurrences than the median of the toxic sample. With no toxic sample at all
    the model finds nothing toxic. What reaches the driver is bounded by `sample_rows` and `size`.
    """
    sample = cut_lineage(labelled_sample(docs, labels, sample_rows))
    chosen = vocabulary(sample, size, min_docs, least_ratio).collect()
    if not chosen:
        return SeverityModel({}, (20.0, 21.0))
    index = {row["feature"]: i for i, row in enumerate(chosen)}
    marker = np.array([row["ratio"] >= marker_ratio for row in chosen])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0):
                counts = _counted(text.as_py())
                found.append(dict(sorted((index[f], n) for f, n in counts.items() if f in index)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).cast(pa.int32()),
                    pa.array([list(x) for x in found], pa.list_(pa.int32())),
                    pa.array([list(x.values()) for x in found], pa.list_(pa.int32())),
                ],
                ["toxic", "columns", "counts"],
            )

    matrix = sample.select("text", "toxic").mapInArrow(
        rows, "toxic int, columns array<int>, counts array<int>"
    )
    # In a fixed order, as sums of doubles depend on it.
    got = matrix.orderBy("toxic", "columns", "counts").toArrow().combine_chunks()
    toxic = got["toxic"].to_numpy()
    lengths = pc.list_value_length(got["columns"]).to_numpy()
    where = np.repeat(np.arange(len(toxic)), lengths)
    columns = pc.list_flatten(got["columns"]).to_numpy().astype(np.int64)
    counts = pc.list_flatten(got["counts"]).to_numpy().astype(np.float64)
    markers = np.bincount(where, counts * marker[columns], minlength=len(toxic))
    middle = np.median(markers[toxic > 0]) if (toxic > 0).any() else 0
    grades = np.where(toxic > 0, 1 + (markers > middle), 0).astype(np.int64)
    grades_used = max(2, int(grades.max()))
    weights, cuts = fit_ordinal(where, columns, np.log1p(counts), grades, len(index))
    if len(cuts) < grades_used:
        cuts = np.append(cuts, cuts[-1] + 1)
    named = {f: float(w) for f, w in zip(index, weights, strict=True)}
    return SeverityModel(named, tuple(float(c) for c in cuts))


def score_severity(
    docs: DataFrame, model: SeverityModel, keep: list[str] | None = None, only_clean: bool = False
) -> DataFrame:
    """The columns `keep` (default: all) with severity, grade and toxic for every document.

    severity is the expected grade, grade the largest one reached with probability 0.5, toxic
    whether that is at least 1. Null, empty and wordless texts score as texts without features.
    With `only_clean`, toxic documents are left out and no column is added. Columns of these names
    in the input are replaced.
    """
    added = ["severity", "grade", "toxic"]
    keep = [c for c in keep or docs.columns if only_clean or c not in added]
    kept = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    weights = model.weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, tuple[str, ...]] = {}
        known = memory.get
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for row, text in enumerate(batch.column(batch.num_columns - 1)):
                text = text.as_py()
                if not text:
                    continue
                found: Counter = Counter()
                for word in _WORD.findall(text.lower()):
                    features = known(word)
                    if features is None:
                        if len(memory) >= 500_000:
                            memory.clear()
                        features = memory[word] = tuple(f for f in features_of(word) if f in weights)
                    if features:
                        found.update(features)
                scores[row] = sum(weights[f] * np.log1p(n) for f, n in sorted(found.items()))
            chances = model.probabilities(scores)
            grade = (chances >= 0.5).sum(1)
            if only_clean:
                rest = batch.drop_columns(["__text"])
                yield rest.filter(pa.array(grade == 0))
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(chances.sum(1)),
                    pa.array(grade, pa.int32()),
                    pa.array(grade > 0),
                ],
                [*keep, *added],
            )

    schema = docs.select(*keep).schema
    if not only_clean:
        schema = schema.add("severity", "double").add("grade", "integer").add("toxic", "boolean")
    return kept.mapInArrow(score, schema)
