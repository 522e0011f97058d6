"""Removing lines that are equal to, or one edit away from, an earlier line of the corpus.

Two lines are within one edit exactly if they share a deletion variant: for lines of one length,
both without their character at the same place; for lines whose lengths differ by one, the shorter
line itself and the longer one without one character. Grouping by hashed variants therefore finds
all of them, and as every line of a group is one edit from the group's line, only the earliest of a
group matters: no pairs inside a group are made.

All variants of all lines would be about a hundred times the corpus. A line emits a variant only
where some other line agrees with it around the deleted place: the "hole" that may hold the edit is
first half of the line, then a sixteenth of that, then single characters, and after each step only
holes in which two different lines agree on everything outside go on. This loses no variant that
two lines share. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage

SPACE = " \t\r\f\v"
_PARTS = 16


def _outside(line: Column, size: Column, start: Column, end: Column) -> Column:
    """Hash of all but the hole [start, end) of a line that is taken as `size` characters long."""
    return F.xxhash64(size, start, end, F.left(line, start), F.right(line, size - end))


def document_lines(docs: DataFrame) -> DataFrame:
    """Non-blank lines of docs(__doc, __version, __text): occurrence `at`, trimmed line, two hashes."""
    lines = docs.select("__doc", "__version", F.posexplode(F.split("__text", "\n", -1)))
    lines = lines.select("__doc", "__version", "pos", F.btrim("col", F.lit(SPACE)).alias("line"))
    return lines.where(F.length("line") > 0).select(
        F.struct(F.col("__doc").isNull().alias("no_id"), "__doc", "__version", "pos").alias("at"),
        "line",
        F.xxhash64("line").alias("id"),
        F.hash("line").alias("id2"),
    )


def _shared_holes(holes: DataFrame) -> DataFrame:
    """Rows of holes(key, id, own, ...) whose key a line of that size shares with another line."""
    dealt = holes.repartition("key")  # one exchange serves both the counts and the join
    shared = (
        dealt.groupBy("key")
        .agg(F.max("own").alias("own"), F.min("id").alias("low"), F.max("id").alias("high"))
        .where(F.col("own") & (F.col("low") != F.col("high")))
        .select("key")
    )
    return dealt.join(shared, "key", "left_semi")


def _half_holes(lines: DataFrame, min_chars: int) -> DataFrame:
    """Holes of half a line, without texts: key, id, own, half. A line stands both among lines of
    its own size and, as the longer one, among lines of one character less."""
    size = F.length("line")
    holes = []
    for own in (True, False):
        of = size if own else size - 1
        middle = F.floor(of / 2).cast("int")
        for half, (start, end) in enumerate(((F.lit(0), middle), (middle, of))):
            key = F.when(of >= max(min_chars, 1), _outside(F.col("line"), of, start, end))
            holes.append(F.struct(key.alias("key"), F.lit(own).alias("own"), F.lit(half).alias("half")))
    return (
        lines.select("id", F.explode(F.array(*holes)).alias("h"))
        .select("h.key", "id", "h.own", "h.half")
        .where(F.col("key").isNotNull())
    )


def _part_holes(texts: DataFrame) -> DataFrame:
    """Sixteenths of the halves of texts(id, line, own, half): key, id, own, start, end."""
    size = F.length("line") - F.when(F.col("own"), 0).otherwise(1)
    middle = F.floor(size / 2).cast("int")
    texts = texts.select(
        "id",
        "line",
        "own",
        size.alias("size"),
        F.when(F.col("half") == 0, 0).otherwise(middle).alias("from"),
        F.when(F.col("half") == 0, middle).otherwise(size).alias("to"),
    ).withColumn("step", F.ceil((F.col("to") - F.col("from")) / _PARTS).cast("int"))
    parts = texts.where(F.col("step") > 0).select(
        "*", F.explode(F.sequence("from", F.col("to") - 1, "step")).alias("start")
    )
    end = F.least(F.col("start") + F.col("step"), F.col("to"))
    return parts.select(
        _outside(F.col("line"), F.col("size"), F.col("start"), end).alias("key"),
        "id",
        "own",
        "start",
        end.alias("end"),
    )


def _variants(texts: DataFrame) -> DataFrame:
    """Deletion variants inside the holes of texts(id, at, line, own, start, end).

    key, id, at and kind: `same` (a line without one character), `short` (a whole line, to be met
    by longer ones) or `long` (a longer line without one character). short and long share keys.
    """
    line, start, end = F.col("line"), F.col("start"), F.col("end")
    size = F.length("line")

    def without(p: Column) -> Column:
        return F.concat(F.left(line, p), F.right(line, size - p - 1))

    def same(p: Column) -> Column:
        key = F.xxhash64(F.lit("same"), size, p, without(p))
        return F.struct(key.alias("key"), F.lit("same").alias("kind"))

    def long(p: Column) -> Column:
        return F.struct(F.xxhash64(F.lit("grown"), without(p)).alias("key"), F.lit("long").alias("kind"))

    short = F.struct(F.xxhash64(F.lit("grown"), line).alias("key"), F.lit("short").alias("kind"))
    own = F.concat(F.transform(F.sequence(start, end - 1), same), F.array(short))
    longer = F.transform(F.sequence(start, end), long)
    emitted = texts.select("id", "at", F.explode(F.when(F.col("own"), own).otherwise(longer)).alias("v"))
    return emitted.select("v.key", "v.kind", "id", "at").distinct()


def near_earlier(lines: DataFrame, min_chars: int) -> DataFrame:
    """Distinct lines with an earlier line one edit away: id and kept_at, the earliest such line.

    Only lines of which the shorter has at least `min_chars` characters are compared.
    """
    halves = _shared_holes(_half_holes(lines, min_chars))
    wanted = halves.groupBy("id").agg(F.collect_set(F.struct("own", "half")).alias("holes"))
    # The texts of the few lines that go on; one row per distinct line, its earliest place. Equal
    # lines are combined before they are dealt, so that a very common one is one row per task.
    distinct = lines.groupBy("id").agg(F.min(F.struct("at", "line")).alias("first"))
    texts = cut_lineage(
        distinct.join(wanted, "id").select("id", "first.at", "first.line", "holes")
    )
    by_half = texts.select("id", "line", F.explode("holes").alias("h")).select(
        "id", "line", "h.own", "h.half"
    )
    parts = _shared_holes(_part_holes(by_half)).drop("key")
    variants = _variants(parts.join(texts.drop("holes"), "id"))
    me = F.struct("at", "id")
    grouped = variants.groupBy("key").agg(
        F.min(F.when(F.col("kind") == "same", me)).alias("same"),
        F.min(F.when(F.col("kind") == "short", me)).alias("short"),
        F.min(F.when(F.col("kind") == "long", me)).alias("long"),
        F.count(F.lit(1)).alias("members"),
    )
    met = variants.join(grouped.where(F.col("members") > 1).drop("members"), "key").select(
        "id",
        "at",
        F.when(F.col("kind") == "same", F.col("same"))
        .when(F.col("kind") == "short", F.col("long"))
        .otherwise(F.col("short"))
        .alias("other"),
    )
    earlier = met.where(F.col("other.at") < F.col("at")).select(
        "id", F.col("other.id").alias("other_id"), F.col("other.at").alias("kept_at")
    ).distinct()
    mine = texts.select("id", "line")
    theirs = texts.select(F.col("id").alias("other_id"), F.col("line").alias("other_line"))
    checked = earlier.join(mine, "id").join(theirs, "other_id")
    checked = checked.where(F.levenshtein("line", "other_line", 1) >= 0)
    return checked.groupBy("id").agg(F.min("kept_at").alias("kept_at"))


def dedup_lines(docs: DataFrame, min_chars: int = 0) -> DataFrame:
    """`docs` with repeated lines taken out of text, plus n_lines and n_dropped.

    A line goes if an earlier line of the corpus is equal to it apart from white space at its ends
    or is one inserted, deleted or replaced character away (with `min_chars`, only where the
    shorter of the two has at least so many characters). Earlier means: smaller doc_id (null ids last), then the text's
    hash, then the line's place. A line that goes itself still makes later lines go. Blank lines
    always stay. A null text stays null and counts no lines; documents are never removed, a
    document without remaining lines has an empty text. Rows equal in doc_id and text are one
    document and get the same result. Columns n_lines and n_dropped of the input are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    base = docs.withColumn("__version", F.xxhash64("text"))
    lines = document_lines(
        base.select(F.col("doc_id").alias("__doc"), "__version", F.col("text").alias("__text"))
    )
    first = lines.groupBy("id", "id2").agg(F.min("at").alias("at"))
    # Cut here, as the rows are compared with each other several times and joined in the end.
    gone = near_earlier(lines, min_chars).select("id")
    kept = first.join(gone, "id", "left_anti").select("at.*")
    by_document = kept.groupBy("__doc", "__version").agg(F.collect_list("pos").alias("__kept"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (base["__version"] == by_document["__version"])
    joined = (
        base.join(by_document, same, "left")
        .drop(by_document["__version"])
        .withColumn("__lines", F.split("text", "\n", -1))
    )
    blank = F.filter(
        F.sequence(F.lit(0), F.size("__lines") - 1),
        lambda i: F.btrim(F.get("__lines", i), F.lit(SPACE)) == "",
    )
    # Both columns are used twice below, so that they are computed once and not for every line.
    joined = joined.withColumn("__blank", blank).withColumn(
        "__stay",
        F.array_sort(F.concat(F.coalesce("__kept", F.array().cast("array<int>")), "__blank")),
    )
    return joined.withColumns(
        {
            "text": F.array_join(F.transform("__stay", lambda i: F.get("__lines", i)), "\n"),
            "n_lines": F.greatest(F.size("__lines"), F.lit(0)),
            "n_dropped": F.greatest(F.size("__lines") - F.size("__stay"), F.lit(0)),
        }
    ).drop("__doc", "__version", "__kept", "__lines", "__blank", "__stay")
