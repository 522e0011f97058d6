"""Language identification: words first, then shorter and shorter character n-grams.

A word that the model knows scores the logarithm of its frequency in each language. A word it has
never seen falls back to its character n-grams (with marks at both ends), longest first: the first
length of which any n-gram is known decides, by the mean log frequency of the known ones. Words
without any known n-gram say nothing. A text's score for a language is the sum over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut_lineage

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies by language: of words (order 0) and of n-grams (order n).

    `names[n]` lists the known words or n-grams, row i of `scores[n]` belongs to its i-th.
    """

    languages: list[str]
    orders: tuple[int, ...]
    names: dict[int, list[str]]
    scores: dict[int, np.ndarray]

    def __post_init__(self):
        self._row = {n: {g: i for i, g in enumerate(known)} for n, known in self.names.items()}

    def word_score(self, word: str) -> np.ndarray | None:
        found = self._row[0].get(word)
        if found is not None:
            return self.scores[0][found]
        for n in self.orders:
            row = self._row[n]
            rows = [row[g] for g in grams_of(word, n) if g in row]
            if rows:
                return self.scores[n][rows].mean(0)
        return None


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; false for a null id."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(rest == 0, F.lit(False))


def training_sample(docs: DataFrame, sample_rows: int) -> DataFrame:
    """lang and text of at most `sample_rows` documents with an id, a text and a lang that are not
    held out: of every language those whose ids have the least hashes, as many of each as there are
    until the sample is full; among them equal texts of a language once."""
    usable = docs.where(
        F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & ~is_held_out(F.col("doc_id"))
    )
    # Only numbers are ordered; the texts are fetched by a join with at most sample_rows ids. Every
    # language gives its first rows before any gives its next ones, so small ones are all in.
    in_lang = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("doc_id", "lang")
        .distinct()
        .withColumn("place", F.row_number().over(in_lang))
        .where(F.col("place") <= sample_rows)
        .orderBy("place", "lang")
        .limit(sample_rows)
        .select("doc_id", "lang")
    )
    picked = usable.select("doc_id", "lang", "text").join(
        F.broadcast(chosen), ["doc_id", "lang"], "left_semi"
    )
    return (
        picked.groupBy("lang", F.xxhash64("text").alias("h"))
        .agg(F.first("text").alias("text"))
        .select("lang", "text")
    )


def fit_languages(
    docs: DataFrame,
    sample_rows: int = 20_000,
    max_words: int = 60_000,
    max_grams: int = 30_000,
    orders: tuple[int, ...] = (5, 4, 3, 2, 1),
    smooth: float = 0.5,
) -> LanguageModel:
    """Count words and n-grams of a bounded sample in Spark and keep the most frequent ones.

    The model holds at most `max_words` words and `max_grams` n-grams of every order, whatever the
    size of the corpus; each language keeps its own most frequent ones, an equal share of that (ties:
    the least in code-point order). Without any usable document it knows no language.
    """
    sample = training_sample(docs, sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            per_language: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                per_language.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
            totals: Counter = Counter()
            for lang, words in per_language.items():
                for word, times in words.items():
                    totals[lang, 0, word] += times
                    for n in orders:
                        for gram in grams_of(word, n):
                            totals[lang, n, gram] += times
            keys = list(totals)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.string()),
                    pa.array([totals[k] for k in keys], pa.int64()),
                ],
                ["lang", "n", "gram", "times"],
            )

    counts = sample.mapInArrow(count, "lang string, n int, gram string, times long")
    by_lang = counts.groupBy("n", "gram", "lang").agg(F.sum("times").alias("times"))
    per_gram = by_lang.groupBy("n", "gram").agg(
        F.collect_list(F.struct("lang", "times")).alias("langs")
    )
    per_gram = cut_lineage(per_gram)
    sums = per_gram.select("n", F.explode("langs").alias("l")).groupBy("n", "l.lang").agg(
        F.sum("l.times").alias("times")
    )
    totals = {(r["n"], r["lang"]): r["times"] for r in sums.collect()}
    languages = sorted({lang for _, lang in totals})
    names: dict[int, list[str]] = {}
    scores: dict[int, np.ndarray] = {}

    def times_in(lang: str) -> Column:
        mine = F.get(F.filter("langs", lambda x: x["lang"] == lang), F.lit(0))
        return F.coalesce(mine["times"], F.lit(0)).cast("double")

    counted = [times_in(lang).alias(f"_{i}") for i, lang in enumerate(languages)]
    by_times = Window.partitionBy("n", "lang").orderBy(F.desc("times"), "gram")
    share = F.when(F.col("n") == 0, max(1, max_words // max(1, len(languages)))).otherwise(
        max(1, max_grams // max(1, len(languages)))
    )
    chosen = (
        per_gram.select("n", "gram", F.explode("langs").alias("l"))
        .select("n", "gram", "l.lang", "l.times")
        .withColumn("place", F.row_number().over(by_times))
        .where(F.col("place") <= share)
        .select("n", "gram")
        .distinct()
    )
    per_gram = cut_lineage(per_gram.join(chosen, ["n", "gram"], "left_semi"))
    for n in (0, *orders):
        # Columnar, one number per language: a row object for each would be several times as large.
        kept = per_gram.where(F.col("n") == n).orderBy("gram").select("gram", *counted).toArrow()
        names[n] = kept.column(0).to_pylist()
        times = np.empty((len(names[n]), len(languages)))
        for i in range(len(languages)):
            times[:, i] = kept.column(i + 1).to_numpy()
        size = [totals.get((n, lang), 0) + smooth * (len(names[n]) + 1) for lang in languages]
        scores[n] = np.log((times + smooth) / np.array(size))
    return LanguageModel(languages, orders, names, scores)


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document, from nothing but its whole text.

    score is the share of the best language when the languages' scores are read as log
    probabilities; ties go to the name that sorts first. A text that is null or has no letter, or
    any text if the model knows no language, is `und` with score 0.
    """
    languages = model.languages
    # Bounded by max_words and max_grams.
    parts = (model.languages, model.orders, model.names, model.scores)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*shared.value)
        places: dict[str, int] = {}
        rows = np.zeros((1024, len(languages)))
        used = 1  # row 0 says nothing

        def place(word: str) -> int:
            nonlocal rows, used
            score = model.word_score(word)
            if score is None:
                places[word] = 0
                return 0
            if used == len(rows):
                rows = np.concatenate([rows, np.zeros_like(rows)])
            rows[used] = score
            places[word] = used
            used += 1
            return places[word]

        known = places.get
        for batch in batches:
            best, scores = [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                if not words or not languages:
                    best.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                if used > 500_000:
                    places.clear()
                    used = 1
                at = [p if (p := known(w)) is not None else place(w) for w in words]
                total = rows[np.array(at)].sum(0)
                top = int(total.argmax())
                best.append(languages[top])
                scores.append(float(1 / np.exp(total - total[top]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")
    ).mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
