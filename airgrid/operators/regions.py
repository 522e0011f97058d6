"""Merging small regions into neighbours until all are large enough."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def merge_to_threshold(
    regions: DataFrame,
    edges: DataFrame,
    region: str = "region",
    value: str = "population",
    threshold: float = 20000.0,
) -> DataFrame:
    """L1: repeatedly merge the smallest region with its smallest neighbour.

    The one-at-a-time order is kept exactly, but independent steps run together: a region may act
    as soon as it is the smallest within two steps of the adjacency graph, because then no other
    merge can change it, its neighbours or its choice. Values must not be negative. Ties follow the
    row order of the one-at-a-time process (original regions by hash of the id, then merged ones in
    the order they were made).

    ``regions`` is ``(region STRING, value)``; ``edges`` is ``(a, b)``, both directions. Returns
    ``(region, value, unmet)``: ids of merged regions are joined with ``-``, the acting one first;
    ``unmet`` marks regions that are still too small because nothing touches them.

    Starts jobs: one round per layer of independent merges, state cut by checkpoints.
    """
    state = cut_lineage(
        regions.select(
            F.col(region).cast("string").alias("id"),
            F.col(region).cast("string").alias("name"),
            F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("size"),
            # Row order: originals in a fixed scattered order, so that equal sizes do not form long
            # chains across the map; merged regions (marked 1) by the step that made them.
            F.array(
                F.struct(
                    F.lit(0).alias("made"),
                    F.lit(0.0).alias("at"),
                    F.xxhash64(F.col(region).cast("string")).alias("by"),
                )
            ).alias("born"),
        )
    )
    links = cut_lineage(
        edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
        .where("a <> b")
        .distinct()
    )
    while True:  # a round with a merge leaves fewer regions, so this ends
        merges = cut_lineage(_independent_merges(state, links, threshold))
        if merges.isEmpty():
            break
        state, links = _apply(state, links, merges)
    return state.select(
        F.col("name").alias(region),
        F.col("size").alias(value),
        (F.col("size") < threshold).alias("unmet"),
    )


def _independent_merges(state: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(act, into)`` that the one-at-a-time process would make, safe to make together."""
    rank = state.select("id", F.struct("size", "born", "id").alias("rank"))
    beside = links.join(rank.withColumnsRenamed({"id": "b", "rank": "rank_b"}), "b")
    near = beside.groupBy("a").agg(F.min("rank_b").alias("low"))
    # Smallest rank within one step, the region itself included.
    one = near.join(rank.withColumnRenamed("id", "a"), "a").select(
        "a", F.least("low", "rank").alias("low"), "rank"
    )
    two = (
        links.join(one.select(F.col("a").alias("b"), F.col("low").alias("low_b")), "b")
        .groupBy("a")
        .agg(F.min("low_b").alias("low2"))
    )
    acting = (
        one.join(two, "a")
        .where((F.col("rank.size") < threshold) & (F.col("rank") == F.least("low", "low2")))
        .select(F.col("a"))
    )
    return (
        beside.join(acting, "a", "left_semi")
        .groupBy("a")
        .agg(F.min("rank_b").alias("pick"))
        .select(F.col("a").alias("act"), F.col("pick.id").alias("into"))
    )


def _apply(state: DataFrame, links: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fold every ``into`` region into its ``act`` region and relabel the links."""
    moved = merges.select(F.col("into").alias("id"), "act")
    joined = (
        state.join(moved, "id", "left")
        .join(merges.select(F.col("act").alias("id"), F.lit(True).alias("acting")), "id", "left")
        .withColumn("key", F.coalesce("act", "id"))
        .withColumn(
            "part",
            F.struct(F.col("acting").isNull().alias("second"), "name", "size", "born"),
        )
    )
    mine, other = F.min("part"), F.max("part")
    grouped = joined.groupBy("key").agg(
        mine.alias("p"), other.alias("q"), F.count(F.lit(1)).alias("n")
    )
    p, q, pair = F.col("p"), F.col("q"), F.col("n") == 2
    step = F.struct(
        F.lit(1).alias("made"), F.col("p.size").alias("at"), F.lit(0).cast("bigint").alias("by")
    )
    merged = grouped.select(
        F.col("key").alias("id"),
        F.when(pair, F.concat_ws("-", p["name"], q["name"])).otherwise(p["name"]).alias("name"),
        F.when(pair, p["size"] + q["size"]).otherwise(p["size"]).alias("size"),
        F.when(pair, F.concat(F.array(step), p["born"])).otherwise(p["born"]).alias("born"),
    )
    relabel = merges.select(F.col("into").alias("old"), F.col("act").alias("new"))
    from_a = links.join(relabel.withColumnsRenamed({"old": "a", "new": "na"}), "a", "left")
    both = from_a.join(relabel.withColumnsRenamed({"old": "b", "new": "nb"}), "b", "left")
    relinked = (
        both.select(F.coalesce("na", "a").alias("a"), F.coalesce("nb", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    return cut_lineage(merged), cut_lineage(relinked)


def region_cells(regions: DataFrame, region: str = "region", cell: str = "cell") -> DataFrame:
    """One row per original cell of each merged region."""
    return regions.withColumn(cell, F.explode(F.split(region, "-")))
