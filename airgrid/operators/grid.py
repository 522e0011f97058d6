"""Hierarchical hexagonal grid on the Albers plane.

A cell is a BIGINT: resolution (4 bits), axial ``q`` (29 bits), axial ``r`` (29 bits). Resolution 8
has hexagons of 0.74 km²; each coarser level is seven times larger. These ids are our own: they are
not ids of any public grid system.

The hierarchy alternates two lattice maps, ``A`` (even level up to odd) and ``B`` (odd level up to
even), with ``A·B = 7``. For both, ``q + c·r mod 7`` numbers the seven children of a cell, and the
parent's coordinates are two linear forms of ``(q, r)`` rounded to the nearest seventh, never a tie.
Deep ancestors go four levels per step, so that the expression stays short and inside generated code
wherever the optimizer moves it.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

# Side in metres at resolution 8 (0.74 km²), and the layout of the id.
SIDE_8 = 533.7
RES_SHIFT, Q_SHIFT, HALF = 58, 29, 1 << 28
AXIS_MASK = (1 << 29) - 1
ROOT3 = math.sqrt(3.0)

# Axial offset of child 0..6 from the centre child, for an odd and an even parent.
CHILD_OF_ODD_PARENT = ((0, 0), (1, 0), (0, -1), (1, -1), (-1, 1), (0, 1), (-1, 0))
CHILD_OF_EVEN_PARENT = ((0, 0), (1, 0), (-1, 1), (0, 1), (0, -1), (1, -1), (-1, 0))


def side(res: int) -> float:
    """Hexagon side in metres."""
    return SIDE_8 * 7.0 ** ((8 - res) / 2)


def cell_area(res: int) -> float:
    """Hexagon area in square metres."""
    return 1.5 * ROOT3 * side(res) ** 2


def pack(q: Column, r: Column, res: int) -> Column:
    """Axial coordinates to a cell id."""
    return (
        F.lit(res << RES_SHIFT)
        + (q + HALF) * F.lit(1 << Q_SHIFT)
        + (r + HALF)
    ).cast("bigint")


def resolution(cell: Column) -> Column:
    """Resolution of a cell id."""
    return F.shiftright(cell, RES_SHIFT).cast("int")


def axial_q(cell: Column) -> Column:
    return F.shiftright(cell, Q_SHIFT).bitwiseAND(AXIS_MASK) - HALF


def axial_r(cell: Column) -> Column:
    return cell.bitwiseAND(AXIS_MASK) - HALF


def child_digit(cell: Column, res: int) -> Column:
    """Which of the seven children of its parent a cell of resolution ``res`` is."""
    return _digit(axial_q(cell), axial_r(cell), res).cast("int")


def _digit(q: Column, r: Column, res: int) -> Column:
    return F.pmod(q + r * (5 if res % 2 == 0 else 3), F.lit(7))


def axial_of(x: Column, y: Column, s: float, turned: bool = False) -> tuple[Column, Column]:
    """Axial coordinates of the hexagon (side ``s``, or ``s·√7`` when turned) that holds a point.

    A hexagon is cut out by three bands; each coordinate is fixed by the floors of two of them.
    """
    a, k = ROOT3 / 3, (7 * s if turned else s)
    if turned:
        q_s, q_r = x * (5 * a / k) + y * (1 / k), x * (4 * a / k) - y * (2 / k)
        r_s = x * (a / k) + y * (3 / k)
    else:
        q_s, q_r = x * (2 * a / k), x * (a / k) - y * (1 / k)
        r_s = x * (a / k) + y * (1 / k)
    return _whole(F.floor(q_s) + F.floor(q_r) + 2, 3), _whole(F.floor(r_s) + F.floor(-q_r) + 2, 3)


def _whole(n: Column, by: int) -> Column:
    """Floor of an integer over a small number; half a step up keeps it clear of rounding."""
    return F.floor((n + 0.5) * (1 / by))


def cell_of(x: Column, y: Column, res: int) -> Column:
    """The cell that holds a planar point; a missing coordinate gives a NULL cell."""
    turned = res % 2 == 1
    return pack(*axial_of(x, y, side(res + 1 if turned else res), turned), res)


def pin(df: DataFrame, out: str, value: Column) -> DataFrame:
    """Add a computed column that later filters refer to instead of repeating its expression.

    A filter or join on a computed column is normally pushed below it by copying the expression into
    the condition, where common parts are not shared. Producing the column as a one-element
    ``explode`` keeps it in generated code and computes it once per row.
    """
    return df.drop(out).select("*", F.explode(F.array(value)).alias(out))


def add_cell(df: DataFrame, x: str, y: str, res: int, out: str = "cell") -> DataFrame:
    """J1 as a column of a table."""
    return pin(df, out, cell_of(F.col(x), F.col(y), res))


def parent(cell: Column, from_res: int, to_res: int) -> Column:
    """Ancestor at ``to_res`` of cells that all have resolution ``from_res``.

    Four (or two) levels at a time are one lookup by the residues of ``q`` and ``r``, because the
    lattice of every second level is a plain multiple. That keeps a deep ancestor a short expression.
    """
    q, r = axial_q(cell), axial_r(cell)
    level = from_res
    while level > to_res:
        step = 4 if level - to_res >= 4 else 2 if level - to_res >= 2 else 1
        if step == 1:
            up_q, up_r = _up(q, r, level)
            q, r = _whole(up_q + 3, 7), _whole(up_r + 3, 7)
        else:
            scale = 7 ** (step // 2)
            at = (F.pmod(q, F.lit(scale)) * scale + F.pmod(r, F.lit(scale))).cast("int")
            table_q, table_r = _offset_tables(level % 2, step)
            q = _whole(q - F.get(F.lit(table_q), at), scale)
            r = _whole(r - F.get(F.lit(table_r), at), scale)
        level -= step
    return pack(q, r, to_res)


def _up(q, r, level: int):
    """Seven times the (fractional) coordinates one level up; works on numbers and Columns."""
    return (q * 3 + r, r * 2 - q) if level % 2 == 0 else (q * 2 - r, q + r * 3)


@lru_cache
def _offset_tables(parity: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Offset of a cell from the centre descendant of its ancestor, by residues, from the rule."""
    scale = 7 ** (levels // 2)
    start_q, start_r = (v.ravel() for v in np.mgrid[0:scale, 0:scale])
    q, r = start_q, start_r
    for step in range(levels):
        up_q, up_r = _up(q, r, parity + step)
        q, r = (up_q + 3) // 7, (up_r + 3) // 7
    return (start_q - scale * q).astype("int32"), (start_r - scale * r).astype("int32")


def add_parent(df: DataFrame, cell: str, from_res: int, to_res: int, out: str) -> DataFrame:
    """J2/C13 as a column of a table."""
    return pin(df, out, parent(F.col(cell), from_res, to_res))


def explode_children(
    df: DataFrame, cell: str, from_res: int, to_res: int, out: str
) -> DataFrame:
    """One row per descendant at ``to_res``; streams through seven-way explodes, no shuffle."""
    staged = df.withColumns({"_q": axial_q(F.col(cell)), "_r": axial_r(F.col(cell))})
    for level in range(from_res, to_res):
        staged = _one_level_down(staged, level)
    return staged.withColumn(out, pack(F.col("_q"), F.col("_r"), to_res)).drop("_q", "_r")


def _one_level_down(df: DataFrame, level: int) -> DataFrame:
    offsets = CHILD_OF_ODD_PARENT if level % 2 else CHILD_OF_EVEN_PARENT
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in offsets])
    q, r = F.col("_q"), F.col("_r")
    down = (q * 2 - r, q + r * 3) if level % 2 else (q * 3 + r, r * 2 - q)
    return (
        df.withColumn("_o", F.explode(table))
        .withColumns({"_q": down[0] + F.col("_o.a"), "_r": down[1] + F.col("_o.b")})
        .drop("_o")
    )


def center(cell: Column, res: int) -> tuple[Column, Column]:
    """Planar centre of cells that all have resolution ``res``."""
    return axial_to_plane(axial_q(cell), axial_r(cell), res)


def axial_to_plane(q: Column, r: Column, res: int) -> tuple[Column, Column]:
    lattice = res
    if res % 2:
        q, r, lattice = q * 2 - r, q + r * 3, res + 1
    s = side(lattice)
    return (q * ROOT3 + r * (ROOT3 / 2)) * s, r * 1.5 * s


def corner_offsets(res: int) -> list[tuple[float, float]]:
    """The six corners relative to the centre, counter-clockwise."""
    s = side(res)
    turn = math.atan2(1.5, 2.5 * ROOT3) if res % 2 else 0.0
    angles = [turn + math.radians(60 * k - 30) for k in range(6)]
    return [(s * math.cos(a), s * math.sin(a)) for a in angles]


def boundary(cell: Column, res: int) -> Column:
    """Ring of six corners as ``ARRAY<STRUCT<x, y>>``, counter-clockwise, not closed."""
    cx, cy = center(cell, res)
    return F.array(
        *[F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in corner_offsets(res)]
    )


def disk_offsets(k: int) -> list[tuple[int, int, int]]:
    """All (dq, dr, distance) within ``k`` steps: ``3k(k+1)+1`` rows."""
    return [
        (dq, dr, max(abs(dq), abs(dr), abs(dq + dr)))
        for dq in range(-k, k + 1)
        for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1)
    ]


def explode_disk(
    df: DataFrame, cell: str, res: int, k: int, out: str = "neighbor", distance: str = "distance"
) -> DataFrame:
    """One row per cell within ``k`` steps, with its ring distance; no join, no shuffle."""
    table = F.array(
        *[
            F.struct(
                F.lit(dq * (1 << Q_SHIFT) + dr).cast("bigint").alias("shift"),
                F.lit(d).alias("d"),
            )
            for dq, dr, d in disk_offsets(k)
        ]
    )
    return (
        df.withColumn("_o", F.explode(table))
        .withColumns({out: F.col(cell) + F.col("_o.shift"), distance: F.col("_o.d")})
        .drop("_o")
    )


@lru_cache
def _path_table(parity: int, levels: int) -> np.ndarray:
    """By the residues of ``q`` and ``r``: the child digits of ``levels`` levels as one number in
    base seven, the digit of the finest level last."""
    scale = 7 ** (levels // 2)
    q, r = (v.ravel() for v in np.mgrid[0:scale, 0:scale])
    path = np.zeros(len(q), dtype="int64")
    for step in range(levels):
        path += (q + r * (5 if (parity + step) % 2 == 0 else 3)) % 7 * 7**step
        up_q, up_r = _up(q, r, parity + step)
        q, r = (up_q + 3) // 7, (up_r + 3) // 7
    return path.astype("int32")


@lru_cache
def _descent_tables(parity: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """By path over an even number of ``levels``: offset of the descendant from its ancestor's centre
    descendant. ``parity`` is that of the finer level (and so of the ancestor's)."""
    path = np.arange(7**levels)
    q, r = np.zeros_like(path), np.zeros_like(path)
    for step in range(levels - 1, -1, -1):
        digit = path // 7**step % 7
        odd = (parity + step + 1) % 2 == 1
        offsets = np.array(CHILD_OF_ODD_PARENT if odd else CHILD_OF_EVEN_PARENT)
        down_q, down_r = (q * 2 - r, q + r * 3) if odd else (q * 3 + r, r * 2 - q)
        q, r = down_q + offsets[digit, 0], down_r + offsets[digit, 1]
    return q.astype("int32"), r.astype("int32")


def add_path(df: DataFrame, cell: str, res: int, base: str, path: str) -> DataFrame:
    """The ancestor at level 0 and the way from it down, as one number in base seven.

    In the order of ``(base, path)`` the descendants of any cell stand together: those of a cell
    ``k`` levels up have the ``7**k`` numbers from a multiple of ``7**k`` on.
    """
    q, r = axial_q(F.col(cell)), axial_r(F.col(cell))
    parts, level = [], res
    while level > 0:
        step = 4 if level >= 4 else 2 if level >= 2 else 1
        place = 7 ** (res - level)
        if step == 1:
            parts.append(_digit(q, r, level) * F.lit(place))
            up_q, up_r = _up(q, r, level)
            q, r = _whole(up_q + 3, 7), _whole(up_r + 3, 7)
        else:
            scale = 7 ** (step // 2)
            at = (F.pmod(q, F.lit(scale)) * scale + F.pmod(r, F.lit(scale))).cast("int")
            table_q, table_r = _offset_tables(level % 2, step)
            parts.append(F.get(F.lit(_path_table(level % 2, step)), at) * F.lit(place))
            q = _whole(q - F.get(F.lit(table_q), at), scale)
            r = _whole(r - F.get(F.lit(table_r), at), scale)
        level -= step
    number = reduce(lambda a, b: a + b, parts, F.lit(0)).cast("bigint")
    return pin(df, "_way", F.struct(pack(q, r, 0).alias("b"), number.alias("p"))).withColumns(
        {base: F.col("_way.b"), path: F.col("_way.p")}
    ).drop("_way")


def cell_at(base: Column, path: Column, res: int) -> Column:
    """The cell of resolution ``res`` at the end of a path from a cell at level 0."""
    q, r = axial_q(base), axial_r(base)
    level = 0
    if res % 2:
        # The top level alone, so that an even number of them is left.
        digit = F.floor(path / F.lit(7 ** (res - 1))).cast("int")
        offsets = CHILD_OF_EVEN_PARENT
        q, r = (
            q * 3 + r + F.get(F.array(*[F.lit(a) for a, _ in offsets]), digit),
            r * 2 - q + F.get(F.array(*[F.lit(b) for _, b in offsets]), digit),
        )
        level = 1
    while level < res:
        step = 4 if res - level >= 4 else 2
        part = F.pmod(F.floor(path / F.lit(7 ** (res - level - step))), F.lit(7**step)).cast("int")
        table_q, table_r = _descent_tables((level + step) % 2, step)
        scale = 7 ** (step // 2)
        q = q * scale + F.get(F.lit(table_q), part)
        r = r * scale + F.get(F.lit(table_r), part)
        level += step
    return pack(q, r, res)


def compact(df: DataFrame, cell: str, res: int) -> DataFrame:
    """Replace every full set of seven siblings by its parent, again and again.

    Cells are numbered along the seven-way path, so a cell's descendants are one range of numbers.
    Six levels at a time: cells meet by their ancestor six levels up, at most 117,649 of them, in the
    order of their numbers; each unbroken run of numbers is cut into the fewest whole cells by
    arithmetic. That is one shuffle; a second one, for full cells of six levels up, moves almost
    nothing. Repeated and missing cells do no harm.
    """
    kept = []
    current = df.select(F.col(cell).alias("cell")).where("cell IS NOT NULL")
    level = res
    while True:
        levels = min(level, 6)
        covers = _compacted(current, level, levels)
        if level - levels == 0:
            kept.append(covers.select("cell"))
            break
        # Read by both branches, and much smaller than the cells in all but scattered sets.
        covers = cut_lineage(covers)
        kept.append(covers.where(F.col("up") < levels).select("cell"))
        current = covers.where(F.col("up") == levels).select("cell")
        level -= levels
    return reduce(lambda a, b: a.unionByName(b), kept).select(F.col("cell").alias(cell))


def _compacted(cells: DataFrame, res: int, levels: int) -> DataFrame:
    """``(cell, up)``: cells of one resolution compacted by at most ``levels`` levels."""
    keyed = add_path(cells, "cell", res, "base", "path")
    group = ["base", "block"]
    keyed = keyed.select("base", F.floor(F.col("path") / F.lit(7**levels)).alias("block"), "path")
    # One exchange: all that follows works on the cells of a block.
    dealt = keyed.repartition(*group).distinct()
    order = F.row_number().over(Window.partitionBy(*group).orderBy("path"))
    runs = (
        dealt.withColumn("run", F.col("path") - order)
        .groupBy(*group, "run")
        .agg(F.min("path").alias("low"), (F.max("path") + 1).alias("high"))
    )
    pieces = [_aligned(F.col("low"), F.col("high"), k, levels) for k in range(levels + 1)]
    listed = runs.select("base", F.explode(F.concat(*pieces)).alias("piece")).select("base", "piece.*")
    cell = reduce(
        lambda rest, k: F.when(F.col("up") == k, cell_at(F.col("base"), F.col("place"), res - k)).otherwise(rest),
        range(levels + 1),
        F.lit(None).cast("bigint"),
    )
    return listed.select(cell.alias("cell"), "up")


def _aligned(low: Column, high: Column, k: int, levels: int) -> Column:
    """The pieces ``(place, up)`` of ``[low, high)`` that are whole cells ``k`` levels up and lie in
    no whole cell above: at most six at either end of the run."""

    def span(width: int) -> tuple[Column, Column]:
        return F.ceil(low / F.lit(width)).cast("bigint"), F.floor(high / F.lit(width)).cast("bigint")

    def listed(start: Column, end: Column) -> Column:
        some = F.transform(
            F.sequence(start, F.greatest(start, end - 1)),
            lambda x: F.struct(x.alias("place"), F.lit(k).alias("up")),
        )
        return F.filter(some, lambda x: x["place"] < end)

    start, end = span(7**k)
    if k == levels:
        return listed(start, end)
    above, below = span(7 ** (k + 1))
    any_above = above < below
    return F.concat(
        listed(start, F.when(any_above, above * 7).otherwise(end)),
        listed(F.when(any_above, below * 7).otherwise(end), end),
    )


def uncompact(df: DataFrame, cell: str, res: int) -> DataFrame:
    """Expand a mixed-resolution set to resolution ``res`` (finer cells are left out).

    A cell's descendants are one range of path numbers. No shuffle.
    """
    ids = df.select(F.col(cell).alias("cell")).withColumn("res", resolution(F.col("cell")))
    levels = [
        add_path(ids.where(F.col("res") == level), "cell", level, "base", "path").select(
            "base",
            (F.col("path") * 7 ** (res - level)).alias("low"),
            F.lit(7 ** (res - level)).alias("size"),
        )
        for level in range(res + 1)
    ]
    ranges = reduce(lambda a, b: a.unionByName(b), levels)
    # Two steps, so that no list is longer than a few thousand numbers.
    step = 7**4
    blocks = F.sequence(F.lit(0), F.floor((F.col("size") - 1) / step))
    ranges = ranges.select("*", F.explode(blocks).alias("block"))
    first = F.col("low") + F.col("block") * step
    count = F.least(F.lit(step), F.col("size") - F.col("block") * step)
    paths = ranges.select("base", F.explode(F.sequence(first, first + count - 1)).alias("path"))
    return paths.select(cell_at(F.col("base"), F.col("path"), res).alias(cell))


def cells_over_box(
    df: DataFrame, xmin: str, xmax: str, ymin: str, ymax: str, res: int, out: str = "cell"
) -> DataFrame:
    """One row per cell whose hexagon can reach the bounding box of the row."""
    if res % 2:
        raise ValueError("axial scan works on even resolutions; take parents for odd ones")
    s = side(res)
    low_r = F.floor(F.col(ymin) / (1.5 * s) - 1)
    high_r = F.ceil(F.col(ymax) / (1.5 * s) + 1)
    staged = df.withColumn("_r", F.explode(F.sequence(low_r, high_r)))
    shift = F.col("_r") / 2
    low_q = F.floor(F.col(xmin) / (ROOT3 * s) - shift - 1)
    high_q = F.ceil(F.col(xmax) / (ROOT3 * s) - shift + 1)
    return (
        staged.withColumn("_q", F.explode(F.sequence(low_q, high_q)))
        .withColumn(out, pack(F.col("_q"), F.col("_r"), res))
        .drop("_q", "_r")
    )


def region_edges(cells: DataFrame, cell: str, region: str, res: int) -> DataFrame:
    """Distinct ordered pairs of different regions that own touching cells."""
    owner = cells.select(F.col(cell).alias("cell"), F.col(region).alias("a"))
    other = cells.select(F.col(cell).alias("neighbor"), F.col(region).alias("b"))
    reach = explode_disk(owner, "cell", res, 1).where("distance = 1")
    return reach.join(other, "neighbor").where("a <> b").select("a", "b").distinct()


# --- ids of the public grid system, for data that already carries them: bit work only ----------

# The twelve base cells that are pentagons (public documentation of that system).
PENTAGON_BASE_CELLS = (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)


def h3_from_text(text: Column) -> Column:
    """15-digit hexadecimal text to BIGINT."""
    return F.conv(text, 16, 10).cast("bigint")


def h3_to_text(cell: Column) -> Column:
    """BIGINT to lower-case hexadecimal text."""
    return F.lower(F.hex(cell))


def h3_resolution(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(15).cast("int")


def h3_base_cell(cell: Column) -> Column:
    return F.shiftright(cell, 45).bitwiseAND(127).cast("int")


def h3_digit(cell: Column, level: int) -> Column:
    """The direction digit (0-6, or 7 when unused) at a level from 1 to 15."""
    return F.shiftright(cell, 3 * (15 - level)).bitwiseAND(7).cast("int")


def h3_parent(cell: Column, res: int) -> Column:
    """Ancestor at ``res``; NULL when the cell is already coarser."""
    unused = (1 << (3 * (15 - res))) - 1
    cleared = cell.bitwiseAND(F.lit(~(15 << 52)).cast("bigint"))
    parent = cleared.bitwiseOR(F.lit(res << 52)).bitwiseOR(F.lit(unused).cast("bigint"))
    return F.when(h3_resolution(cell) >= res, parent)


def h3_children(df: DataFrame, cell: str, from_res: int, to_res: int, out: str) -> DataFrame:
    """Descendants at ``to_res``; a pentagon has no child 1."""
    staged = df.withColumn(out, F.col(cell))
    for level in range(from_res + 1, to_res + 1):
        place = 3 * (15 - level)
        used = ((1 << (3 * (level - 1))) - 1) << (3 * (16 - level))
        pentagon = h3_base_cell(F.col(out)).isin(*PENTAGON_BASE_CELLS) & (
            F.col(out).bitwiseAND(F.lit(used).cast("bigint")) == 0
        )
        staged = staged.withColumn("_pent", pentagon)
        staged = (
            staged.withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(6))))
            .where(~(F.col("_pent") & (F.col("_d") == 1)))
            .withColumn(
                out,
                F.col(out)
                .bitwiseAND(F.lit(~(7 << place)).cast("bigint"))
                .bitwiseOR(F.col("_d") * F.lit(1 << place).cast("bigint"))
                .bitwiseAND(F.lit(~(15 << 52)).cast("bigint"))
                .bitwiseOR(F.lit(level << 52).cast("bigint")),
            )
            .drop("_pent", "_d")
        )
    return staged
