"""Delimited text inputs and columnar snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import lenient_number, name_year, without_comment

BAD = "_bad_record"
ZONES = "_zones"


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | str,
    comment: str | None = None,
    reject: bool = False,
) -> DataFrame:
    """A1/A2/A4: headed CSV files with a stated schema, all files as one table.

    Lines that start with ``comment`` are skipped. With ``reject=True`` rows that do not fit are kept
    with their text in ``_bad_record``; otherwise their unreadable fields are NULL (A16).
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if reject:
        struct = T.StructType([*struct.fields, T.StructField(BAD, T.StringType())])
    reader = spark.read.schema(struct).option("header", "true").option("mode", "PERMISSIVE")
    if reject:
        reader = reader.option("columnNameOfCorruptRecord", BAD)
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(paths)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rows that could not be read."""
    return df.where(F.col(BAD).isNull()).drop(BAD), df.where(F.col(BAD).isNotNull())


def read_text_columns(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str],
    numbers: list[str],
    comment: str | None = "#",
) -> DataFrame:
    """A3: every column as text, then the listed ones read leniently as numbers."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    text = read_csv(spark, paths, schema, comment)
    return text.withColumns({c: lenient_number(F.col(c)) for c in numbers})


def cut_comments(spark: SparkSession, paths: str | list[str], comment: str = "#") -> DataFrame:
    """A2: lines with everything from the comment mark on removed, and empty lines dropped.

    Feed the ``value`` column to :func:`parse_lines` when a file has comments in the middle of
    lines. A mark inside double quotes is text.
    """
    return clean_lines(spark.read.text(paths), comment)


def clean_lines(lines: DataFrame, comment: str = "#") -> DataFrame:
    """A2 for lines in a ``value`` column; other columns pass through."""
    cut = lines.withColumn("value", without_comment(F.col("value"), comment))
    return cut.where("value <> ''")


def parse_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Rows of ``cut_comments`` lines. A line that consists of exactly the schema's column names is
    a header, whichever file it comes from; blanks and quotes around the names do not matter."""
    names = T.StructType.fromDDL(schema).fieldNames()
    bare = F.regexp_replace("value", '[ "]', "")
    body = lines.where(bare != ",".join(n.replace(" ", "") for n in names))
    return body.select(F.from_csv("value", schema).alias("row")).select("row.*")


def read_records(lines: DataFrame, schema: str, text: str = "value") -> DataFrame:
    """A16 for lines in a column: the other columns, the parsed fields, and ``_bad_record`` with
    the text of a line that does not fit the schema."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    read = lines.withColumn("_row", F.from_csv(text, f"{schema}, {BAD} string", options))
    return read.drop(text).select("*", "_row.*").drop("_row")


def read_many(spark: SparkSession, parts: dict[str, str]) -> DataFrame:
    """A4: files with different columns as one table, missing columns NULL.

    ``parts`` maps a path to its schema.
    """
    tables = [read_csv(spark, p, s) for p, s in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_file_year(
    df: DataFrame, out: str = "year", pattern: str | None = None
) -> DataFrame:
    """A5/H7: the year in the name of the file a row came from, as :func:`name_year` finds it."""
    return df.withColumn(out, name_year(F.col("_metadata.file_path"), pattern))


def write_snapshot(df: DataFrame, path: str) -> None:
    """Columnar snapshot."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Columnar snapshot."""
    return spark.read.parquet(path)


def write_sorted(df: DataFrame, keys: list[str], path: str, partitions: int | None = None) -> None:
    """Range-partitioned and sorted on the keys, with a table of zones beside the files: one
    row per file with its least and greatest first key (see :func:`read_range`)."""
    ranged = (
        df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    )
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").option(
        "compression", "zstd"
    ).parquet(path)
    # Least and greatest come from the files' own statistics or one column; names that begin with an
    # underscore are no part of the snapshot.
    spark, key = df.sparkSession, F.col(keys[0])
    zones = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows")
    )
    zones.coalesce(1).write.mode("overwrite").parquet(f"{path}/{ZONES}")


def read_range(spark: SparkSession, path: str, key: str, low: Column, high: Column) -> DataFrame:
    """Rows of a sorted snapshot with ``low <= key <= high``.

    Only files whose zone overlaps the range are opened, and the condition is pushed down to their
    row groups. One name per such file is collected. Rows with a NULL key are in no range.
    """
    zones = spark.read.parquet(f"{path}/{ZONES}")
    wanted = zones.where((F.col("low") <= high) & (F.col("high") >= low)).select("file").collect()
    whole = spark.read.parquet(path)
    if not wanted:
        return whole.where(F.lit(False))
    rows = spark.read.schema(whole.schema).parquet(*[r["file"] for r in wanted])
    return rows.where(F.col(key).between(low, high))


def write_partitioned(
    df: DataFrame, path: str, keys: list[str], spread: list[str] | None = None
) -> None:
    """One folder per key combination; existing folders of other keys stay.

    ``spread`` adds columns to the shuffle so that one large folder is written by many tasks.
    """
    df.repartition(*keys, *(spread or [])).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("compression", "zstd").partitionBy(*keys).parquet(path)
