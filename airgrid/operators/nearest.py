"""Distance to the nearest feature by branch and bound over runs of features (C11).

Features are laid out along a z-order curve and numbered; a leaf is a run of at most 64 of them,
whatever their distribution, and a node above is a run of 16 nodes. Every node keeps the box of its
features and one of those features. Points walk down from the root; a node whose box is further
away than a feature already met is dropped. What is left at the bottom is a handful of leaves per
point, and only their features are measured. The depth follows the number of features, so a small
table is searched in one or two steps, and a crowded place is split as finely as it is crowded.
The answer is exact for any distribution: nothing is capped, and no group is compared all-to-all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

# The curve covers a plane of 8,388,608 m around the origin in steps of 1/4 m.
ROOT_BITS = 23
CURVE_BITS = 25
LEAF_BITS = 6
FAN_BITS = 4
SALTS = 64  # copies of nodes that all points share, near the root
LOW_SALTS = 8  # copies of the others


def segment_distance2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance from a point to a segment (or point, when both ends agree)."""
    dx, dy = x2 - x1, y2 - y1
    along = F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ex, ey = px - (x1 + dx * t), py - (y1 + dy * t)
    return ex * ex + ey * ey


def split_segments(lines: DataFrame, max_length: float) -> DataFrame:
    """Cut long segments into pieces, so that their boxes stay small; the geometry is the same."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    pieces = F.greatest(F.lit(1), F.ceil(F.sqrt(dx * dx + dy * dy) / max_length)).cast("int")
    cut = lines.withColumns({"_n": pieces, "_dx": dx, "_dy": dy}).withColumn(
        "_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    )
    start, end = F.col("_k") / F.col("_n"), (F.col("_k") + 1) / F.col("_n")
    ends = {
        "x2": F.when(F.col("_k") + 1 == F.col("_n"), F.col("x2")).otherwise(F.col("x1") + F.col("_dx") * end),
        "y2": F.when(F.col("_k") + 1 == F.col("_n"), F.col("y2")).otherwise(F.col("y1") + F.col("_dy") * end),
    }
    starts = {"x1": F.col("x1") + F.col("_dx") * start, "y1": F.col("y1") + F.col("_dy") * start}
    return cut.withColumns({**ends, **starts}).drop("_n", "_dx", "_dy", "_k")


def nearest_join(
    points: DataFrame,
    features: DataFrame,
    by: list[str] | None = None,
    x: str = "x",
    y: str = "y",
    feature_id: str = "feature_id",
    leaf_bits: int = LEAF_BITS,
    distance: str = "distance",
) -> DataFrame:
    """C11: add the distance to, and id of, the nearest feature with equal ``by`` values.

    ``features`` has ``(feature_id, x1, y1, x2, y2, *by)``; points have ``x1 = x2, y1 = y2``. Of
    equally near features the lowest id is named. Points without any feature get NULL; features
    without all coordinates are nowhere. Leaves hold at most ``2**leaf_bits`` features. Starts a job that writes the features in order.
    """
    by = by or []
    # Features that coincide are one feature; equal point locations are asked about once.
    placed = features.dropna(subset=["x1", "y1", "x2", "y2"])
    shapes, bits = _ordered(
        placed.groupBy(*by, "x1", "y1", "x2", "y2").agg(F.min(feature_id).alias("_fid")), by
    )
    spots = points.select(*by, x, y).where(
        F.col(x).isNotNull() & F.col(y).isNotNull()
    ).distinct()
    found = _descend(spots, shapes, by, x, y, bits, leaf_bits)
    leaves = shapes.withColumn("_node", F.shiftright("_at", leaf_bits)).drop("_at")
    leaf = found.join(leaves, [*by, "_node"]).withColumn(
        "_d2", segment_distance2(F.col(x), F.col(y), *_ends(F.col))
    )
    best = leaf.groupBy(*by, x, y).agg(F.min(F.struct("_d2", "_fid")).alias("_best"))
    return points.join(
        best.select(
            *by,
            x,
            y,
            F.sqrt("_best._d2").alias(distance),
            F.col("_best._fid").alias(feature_id),
        ),
        [*by, x, y],
        "left",
    )


def _ends(make) -> list[Column]:
    return [make(c) for c in ("x1", "y1", "x2", "y2")]


def _z_order(shapes: DataFrame) -> Column:
    """Place of the middle of a feature on the curve; features off the plane go to its rim."""

    def spread(a: str, b: str) -> Column:
        """Bits of a coordinate, each followed by a gap."""
        middle = (F.col(a) + F.col(b)) / 2 + float(1 << (ROOT_BITS - 1))
        step = F.floor(middle * float(1 << (CURVE_BITS - ROOT_BITS))).cast("bigint")
        bits = F.greatest(F.lit(0), F.least(F.lit((1 << CURVE_BITS) - 1), step)).cast("bigint")
        width = 16
        while width:
            # Move the upper half of every group of 2 * width bits up by width.
            group = sum(((1 << width) - 1) << at for at in range(0, 64 - width, 2 * width))
            bits = bits.bitwiseOR(F.shiftleft(bits, width)).bitwiseAND(F.lit(group))
            width //= 2
        return bits

    return spread("x1", "x2").bitwiseOR(F.shiftleft(spread("y1", "y2"), 1))


def _ordered(shapes: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """Shapes with their place ``_at`` in the order of (``by``, curve), and the bits of the places.

    Places grow along ranges of the order; the gaps between ranges are whole runs. The rows are
    written once, so every later reading sees the same places.
    """
    spread = shapes.withColumn("_z", _z_order(shapes))
    ranged = spread.repartitionByRange(*by, "_z", "x1", "y1").sortWithinPartitions(*by, "_z")
    # Number of the range, and place in the range below 33 bits.
    numbered = cut_lineage(ranged.drop("_z").withColumn("_id", F.monotonically_increasing_id()))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    ranges, rows = numbered.agg(F.max(F.shiftright("_id", 33)), F.max(inside)).first()
    width = (rows or 0).bit_length()
    at = F.shiftleft(F.shiftright("_id", 33), width) + inside
    return numbered.withColumn("_at", at).drop("_id"), width + (ranges or 0).bit_length()


def _nodes(shapes: DataFrame, by: list[str], shift: int) -> DataFrame:
    """One row per run of ``2**shift`` places: its box, one of its features, and the run above."""
    boxes = shapes.groupBy(*by, F.shiftright("_at", shift).alias("_child")).agg(
        F.min(F.least("x1", "x2")).alias("_bx1"),
        F.max(F.greatest("x1", "x2")).alias("_bx2"),
        F.min(F.least("y1", "y2")).alias("_by1"),
        F.max(F.greatest("y1", "y2")).alias("_by2"),
        *[F.min_by(c, "_fid").alias(f"_r{c}") for c in ("x1", "y1", "x2", "y2")],
    )
    return boxes.withColumn("_node", F.shiftright("_child", FAN_BITS))


def _descend(
    spots: DataFrame, shapes: DataFrame, by: list[str], x: str, y: str, bits: int, leaf_bits: int
) -> DataFrame:
    """The leaves that may hold the nearest feature of each point: ``(*by, x, y, _node)``."""
    zero = F.lit(0).cast("bigint")
    walk = spots.withColumns({"_node": zero, "_bound": F.lit(float("inf"))})
    px, py = F.col(x), F.col(y)
    out_x = F.greatest(F.col("_bx1") - px, px - F.col("_bx2"), F.lit(0.0))
    out_y = F.greatest(F.col("_by1") - py, py - F.col("_by2"), F.lit(0.0))
    per_point = Window.partitionBy(*by, x, y)
    steps = max(0, -(-(bits - leaf_bits) // FAN_BITS))
    for step in range(steps):
        # Many points share a node, near the root all of them: spread them over copies of it.
        copies = SALTS if step < 2 else LOW_SALTS
        salts = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        shift = leaf_bits + FAN_BITS * (steps - 1 - step)
        children = _nodes(shapes, by, shift).withColumn("_salt", salts)
        salted = walk.withColumn("_salt", F.pmod(F.hash(x, y), F.lit(copies)))
        met = salted.join(children, [*by, "_node", "_salt"]).withColumns(
            {
                "_low": out_x * out_x + out_y * out_y,
                "_high": segment_distance2(px, py, *_ends(lambda c: F.col(f"_r{c}"))),
            }
        )
        met = met.where(F.col("_low") <= _slack(F.col("_bound"))).withColumn(
            "_bound", F.least(F.col("_bound"), F.min("_high").over(per_point))
        )
        walk = met.where(F.col("_low") <= _slack(F.col("_bound"))).select(
            *by, x, y, F.col("_child").alias("_node"), "_bound"
        )
    return walk.drop("_bound")


def _slack(bound: Column) -> Column:
    """Room for rounding, so that pruning can never lose the true nearest feature."""
    return bound * (1 + 1e-9) + 1e-6
