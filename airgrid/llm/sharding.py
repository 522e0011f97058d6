"""Jump consistent hashing: a stable key and the shard count alone decide the shard.

Going from n to n + 1 shards, a row either stays or moves to the new shard n, and about 1/(n+1) of
the rows move. No table of ring positions is kept. Column expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import number_rows, prefix_digits, scatter

# Fixed value: the multiplier of the published 64-bit generator.
MULTIPLIER = 2862933555777941757
_LOW32 = 0xFFFFFFFF


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2**64 on two 32-bit halves; no step leaves 63 bits."""
    factor_high, factor_low = MULTIPLIER >> 32, MULTIPLIER & _LOW32
    upper, lower = factor_low >> 16, factor_low & 0xFFFF
    middle = low * F.lit(upper)
    partial = low * F.lit(lower) + F.lit(1) + F.shiftleft(middle.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(partial, 32) + F.shiftright(middle, 16)
    crossed = high * F.lit(lower) + F.shiftleft((high * F.lit(upper)).bitwiseAND(F.lit(0xFFFF)), 16)
    next_high = (low * F.lit(factor_high)).bitwiseAND(F.lit(_LOW32)) + crossed + carry
    return next_high.bitwiseAND(F.lit(_LOW32)), partial.bitwiseAND(F.lit(_LOW32))


def jump_shards(key: Column, counts: Sequence[int]) -> Column:
    """A struct with one shard (field n<count>) for each of `counts`, from one walk of the jumps.

    `key` is a 64-bit integer; null counts as key 0. Each jump moves forward, so `max(counts)`
    steps always reach the end of the walk.
    """
    if not counts or min(counts) < 1:
        raise ValueError("every shard count must be at least 1")
    most = max(counts)
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    found = [f"n{c}" for c in counts]

    def step(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        ratio = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double")
        jumped = F.floor((state["jump"] + F.lit(1)).cast("double") * ratio).cast("long")
        running = state["jump"] < F.lit(most)
        return F.struct(
            high.alias("high"),
            low.alias("low"),
            F.when(running, jumped).otherwise(state["jump"]).alias("jump"),
            *[
                F.when(state["jump"] < F.lit(c), state["jump"]).otherwise(state[name]).alias(name)
                for c, name in zip(counts, found, strict=True)
            ],
        )

    zero = F.lit(0).cast("long")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(_LOW32)).alias("low"),
        zero.alias("jump"),
        *[zero.alias(name) for name in found],
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step)


def assign_shards(
    df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = None
) -> DataFrame:
    """Add the shard of each row and, if named, its shard after one more shard is appended.

    Rows with equal keys, also repeated rows, go to one shard. Null keys go where key 0 goes.
    Other columns pass through; a column already called `shard` or `grown` is replaced.
    """
    counts = [shards, shards + 1] if grown else [shards]
    walked = df.withColumn("__walk", jump_shards(F.col(key), counts))
    walked = walked.withColumn(shard, F.col(f"__walk.n{shards}").cast("int"))
    if grown:
        walked = walked.withColumn(grown, F.col(f"__walk.n{shards + 1}").cast("int"))
    return walked.drop("__walk")


def shard_documents(
    docs: DataFrame, shards: int = 24, block_rows: int = 50_000, seed: int = 0
) -> DataFrame:
    """Documents with size, text_crc32, law, shard, slot (gapless in the shard) and grown_shard.

    Size is the text's UTF-8 bytes plus 8; a null text has no bytes and checksum 0. Slots follow a
    pseudo-random order of doc_id. Only the small columns are ordered, never the texts.
    """
    # crc32 of a string column reads its UTF-8 bytes.
    text = F.coalesce(F.col("text"), F.lit(""))
    small = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + F.lit(8)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = assign_shards(small, "doc_id", shards, grown="grown_shard").withColumn(
        "__order", scatter(F.col("doc_id"), seed)
    )
    digits = prefix_digits(docs.count(), shards * block_rows)
    placed = placed.withColumn("__block", F.substring("__order", 1, digits))
    order = [F.col("__order"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    numbered = number_rows(placed, "slot", ["shard"], "__block", order)
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
