"""The corpus pipeline: a list of stages, each one operator applied to what the stage before kept.

`run` writes every stage's rows as Parquet in the shared checkpoint folder and reads them again as
the next stage's documents, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.llm import line_dedup, mixing, ngram_join, packing, toxicity
from airgrid.llm.tables import cut_lineage, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of grade 0; the model is fitted on the labelled ones among `docs`."""
    model = toxicity.fit_severity(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_severity(docs, model, only_clean=True)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that stand earlier in the corpus."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that n-gram similarity links."""
    return ngram_join.one_of_each(docs, ngram_join.similar_documents(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order of the mixture."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mixed = mixing.mix(docs, law="weights")
    return mixing.in_mixture_order(mixed, parts).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document; sequences follow the order of the rows in `docs`' files."""
    placed = packing.file_positions(docs.select("doc_id", "text"), "position")
    return packing.pack_documents(placed, order="position")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram join", keep_one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Tokenizing, a fitted model and signatures are beyond SQL. The tests hold the operators against brute
# force, and the stages' columns, row counts and effects; not yet every row of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
