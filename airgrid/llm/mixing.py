"""Mixing sources to target weights by Pfair scheduling.

Every source s with weight w is cut into blocks of `block_rows` rows. Block j (from 0) may not start
before slot floor(j / w) and must be placed before slot ceil((j + 1) / w); among the blocks that may
start, each slot takes the one with the earliest deadline. Every prefix of the schedule then holds
each source's share to within less than one block, as long as all sources have blocks left.

Weights are whole units out of `frame` slots. After `frame` slots every source is exactly at its
share, so the schedule repeats, and one frame decides the place of every block by arithmetic.
Column expressions only.

The units are rounded, each source has one at least, and the frame repeats the error (law `frame`).
Law `weights` follows the weights themselves without an end and has no frame: a binary tree of sources is
built, lightest first, and each node deals its slots to its two halves in proportion, so that the
left half has round(n * share) of the first n. A block's slot is worked out by going up from its
source, in whole numbers. Every prefix holds each share to within less than two blocks, whatever the
number of sources and rows, as long as all sources have blocks left.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import number_rows, prefix_digits, scatter


def _source_key(source: Column) -> Column:
    """Null is a source of its own, apart from the empty name."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def source_weights(
    docs: DataFrame, weights: Mapping[str, float] | None, power: float
) -> DataFrame:
    """One row per source: source_key, rows, weight.

    Without `weights` a source weighs rows ** power. Sources absent from `weights` weigh as much
    as the lightest one named.
    """
    counts = docs.groupBy(_source_key(F.col("source")).alias("source_key")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    if weights:
        if min(weights.values()) <= 0:
            raise ValueError("weights must be positive")
        named = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (f"={k}", float(w))])
        weight = F.coalesce(named[F.col("source_key")], F.lit(float(min(weights.values()))))
    else:
        weight = F.pow(F.col("rows").cast("double"), F.lit(power))
    return counts.withColumn("weight", weight)


def source_units(
    docs: DataFrame, weights: Mapping[str, float] | None, power: float, frame: int
) -> DataFrame:
    """One row per source: source_key, rows, units; units add up to `frame`, each at least 1.

    Units are rounded by largest remainders, ties to the smaller name. The number of sources must
    not exceed `frame`; the query fails if it does.
    """
    everything = Window.partitionBy(F.lit(0))  # one row per source
    shares = source_weights(docs, weights, power).select(
        "source_key",
        "rows",
        F.count(F.lit(1)).over(everything).alias("sources"),
        (F.col("weight") / F.sum("weight").over(everything)).alias("share"),
    )
    spare = (F.lit(frame) - F.col("sources")) * F.col("share")
    shares = shares.withColumn("floor", F.floor(spare).cast("long")).withColumn(
        "left", spare - F.floor(spare)
    )
    by_left = Window.partitionBy(F.lit(0)).orderBy(F.desc("left"), "source_key")
    missing = F.lit(frame) - F.col("sources") - F.sum("floor").over(everything)
    units = F.lit(1) + F.col("floor") + (F.row_number().over(by_left) <= missing).cast("long")
    fits = F.assert_true(F.col("sources") <= frame, F.lit("more sources than slots in a frame"))
    return shares.select(
        "source_key", "rows", F.when(fits.isNull(), units).alias("units")
    )


def frame_schedule(units: DataFrame, frame: int) -> DataFrame:
    """The slots of one frame: source_key, units, turn (from 0 in the source), slot.

    Works on one row that holds all sources, as the frame is bounded by its number of slots.
    """
    gathered = units.agg(
        F.array_sort(F.collect_list(F.struct("source_key", "units"))).alias("sources")
    ).where(F.size("sources") > 0)

    def slot(state: Column, now: Column) -> Column:
        def due(source: Column, i: Column) -> Column:
            used = F.get(state["used"], i)
            units_ = source["units"]
            ready = (used < units_) & (F.floor(used * frame / units_) <= now)
            return F.when(ready, F.struct(F.ceil((used + 1) * frame / units_).alias("due"), i.alias("i")))

        choice = F.array_min(F.transform(F.col("sources"), due))["i"]
        return F.struct(
            F.transform(
                state["used"], lambda n, i: n + F.when(i == choice, 1).otherwise(0).cast("long")
            ).alias("used"),
            F.concat(state["order"], F.array(choice)).alias("order"),
        )

    start = F.struct(
        F.transform("sources", lambda _: F.lit(0).cast("long")).alias("used"),
        F.array().cast("array<int>").alias("order"),
    )
    order = gathered.select(
        "sources",
        F.aggregate(
            F.sequence(F.lit(0), F.lit(frame - 1)), start, slot, lambda state: state["order"]
        ).alias("order"),
    )
    slots = order.select("sources", F.posexplode("order").alias("slot", "i")).select(
        F.col("sources")[F.col("i")].alias("s"), "slot"
    )
    turns = Window.partitionBy("source_key").orderBy("slot")
    return slots.select("s.source_key", "s.units", "slot").withColumn(
        "turn", F.row_number().over(turns) - 1
    )


def _frame_slots(
    docs: DataFrame,
    ranked: DataFrame,
    weights: Mapping[str, float] | None,
    power: float,
    frame: int,
) -> DataFrame:
    """Add __frame and slot to rows with __source and source_block, by the repeated frame."""
    plan = frame_schedule(source_units(docs, weights, power, frame), frame)
    per_source = plan.groupBy(F.col("source_key").alias("__source")).agg(
        F.first("units").alias("__units"), F.array_sort(F.collect_list("slot")).alias("__slots")
    )  # at most `frame` numbers in all
    return (
        ranked.join(F.broadcast(per_source), "__source")
        .withColumn("__frame", F.floor(F.col("source_block") / F.col("__units")).cast("long"))
        .withColumn(
            "slot",
            F.col("__frame") * frame
            + F.get("__slots", (F.col("source_block") % F.col("__units")).cast("int")),
        )
        .drop("__units", "__slots")
    )


def tree_paths(weights: Mapping[str, int]) -> dict[str, list[tuple[int, int, int]]]:
    """For every source the steps (own, whole, left) from its leaf of the tree up to the root.

    `own` and `whole` are the weights of a node and of its parent; `left` is 1 in a left half. The
    two lightest nodes are joined first, ties to the smaller name and then to the older node.
    """
    heap = [(w, i, i) for i, (_, w) in enumerate(sorted(weights.items()))]
    heapq.heapify(heap)
    up: dict[int, tuple[int, int, int, int]] = {}  # node: parent and its step
    made = len(heap)
    while len(heap) > 1:
        right_weight, _, right = heapq.heappop(heap)
        left_weight, _, left = heapq.heappop(heap)
        whole = left_weight + right_weight
        up[left], up[right] = (made, left_weight, whole, 1), (made, right_weight, whole, 0)
        heapq.heappush(heap, (whole, made, made))
        made += 1
    paths = {}
    for node, name in enumerate(sorted(weights)):
        steps = []
        while node in up:
            node, *step = up[node]
            steps.append(tuple(step))
        paths[name] = steps
    return paths


def _tree_slots(
    docs: DataFrame, placed: DataFrame, weights: Mapping[str, float] | None, power: float
) -> DataFrame:
    """Add slot to rows with __source and source_block, by the tree of sources."""
    found = source_weights(docs, weights, power).select("source_key", "weight").collect()
    total = sum(sorted(r["weight"] for r in found))
    # Whole numbers below 2 ** 31 in all, so that no product of two exceeds 62 bits.
    whole = {r["source_key"]: max(1, round(r["weight"] / total * 2**30)) for r in found}
    paths = [{"s": s, "p": [list(step) for step in steps]} for s, steps in tree_paths(whole).items()]
    spark = docs.sparkSession
    schema = "array<struct<s:string,p:array<array<bigint>>>>"
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(paths)), schema)))

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    def up(n: Column, step: Column) -> Column:
        """Place in the parent of a node's block n: whole * (2n + 1) - left over 2 * own."""
        own, whole_, left = step[0], step[1], step[2]
        rest = div(whole_ * (n % own * 2 + 1) - left, own * 2)
        return whole_ * div(n, own) + rest

    return (
        placed.join(F.broadcast(table), F.col("__source") == F.col("s"))
        .withColumn("slot", F.aggregate("p", F.col("source_block"), up))
        .drop("s", "p")
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    power: float = 0.7,
    frame: int = 1024,
    block_rows: int = 8,
    numbering_rows: int = 2_000,
    seed: int = 0,
    law: str = "frame",
) -> DataFrame:
    """All rows of `docs` with their place in the mixture; no row is dropped or repeated.

    Adds source_block (the block in its source), slot (its slot in the schedule, from 0), and
    position (the row's place in the mixture, gapless from 0). Inside a source, rows come in a
    pseudo-random order of doc_id. When a source runs out, its slots stay empty and the others
    keep their proportions. A null source is a source of its own. Repeated rows each get a place.
    Columns of these names in the input are replaced. An empty table gives no rows.

    Law `frame` repeats a frame of rounded units, which bounds the number of sources; law `weights`
    follows the weights over any number of rows and sources, and `frame` only cuts its numbering.
    """
    if law not in ("frame", "weights"):
        raise ValueError(f"no law {law}")
    docs = docs.drop("source_block", "slot", "position")
    rows = docs.count()
    digits = prefix_digits(rows, numbering_rows)
    keyed = (
        docs.withColumn("__source", _source_key(F.col("source")))
        .withColumn("__order", scatter(F.col("doc_id"), seed))
        .withColumn("__digits", F.substring("__order", 1, digits))
    )
    # xxhash64 of the text tells rows with one doc_id apart.
    ranked = number_rows(
        keyed, "__row", ["__source"], "__digits", [F.col("__order"), F.xxhash64("text")]
    )
    block = F.floor(F.col("__row") / block_rows).cast("long")
    ranked = ranked.withColumn("source_block", block)
    if law == "weights":
        placed = _tree_slots(docs, ranked, weights, power).withColumn(
            "__frame", F.floor(F.col("slot") / frame).cast("long")
        )
    else:
        placed = _frame_slots(docs, ranked, weights, power, frame)
    in_order = [F.col("slot"), F.col("__row")]
    return number_rows(placed, "position", [], "__frame", in_order).drop(
        "__source", "__order", "__digits", "__row", "__frame"
    )


def in_mixture_order(mixed: DataFrame, partitions: int) -> DataFrame:
    """Lay the rows out by position: ranges over partitions, ordered inside each."""
    return mixed.repartitionByRange(partitions, "position").sortWithinPartitions("position")
