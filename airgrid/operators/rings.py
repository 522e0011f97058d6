"""Many rings at once in NumPy: cutting at tile borders and clipping to convex rings.

A bundle of rings is ``(x, y, start)``: the corners of all rings one after the other, and where each
ring starts, with the end as one more entry. Everything here is arithmetic on whole bundles; which
rings meet is decided by Spark. The functions travel by value, so executors need no copy of them.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Bundle = tuple[np.ndarray, np.ndarray, np.ndarray]

# Corners that are worked on at a time, which bounds the memory of a task.
AT_ONCE = 200_000


def _owner(start: np.ndarray) -> np.ndarray:
    """Of every corner: the number of its ring."""
    return np.repeat(np.arange(len(start) - 1), np.diff(start))


def _before(start: np.ndarray) -> np.ndarray:
    """Of every corner: the place of the corner before it in its ring."""
    at = np.arange(start[-1]) - 1
    some = np.diff(start) > 0
    at[start[:-1][some]] = start[1:][some] - 1
    return at


def _take(bundle: Bundle, which: np.ndarray) -> Bundle:
    x, y, start = bundle
    sizes = np.diff(start)[which]
    new = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(new[-1]) + np.repeat(start[:-1][which] - new[:-1], sizes)
    return x[at], y[at], new


def _keep(bundle: Bundle, corners: np.ndarray) -> Bundle:
    x, y, start = bundle
    return x[corners], y[corners], np.concatenate([[0], np.cumsum(corners)])[start]


def _join(bundles: list[Bundle]) -> Bundle:
    sizes = np.concatenate([np.diff(start) for _, _, start in bundles])
    return (
        np.concatenate([x for x, _, _ in bundles]),
        np.concatenate([y for _, y, _ in bundles]),
        np.concatenate([[0], np.cumsum(sizes)]),
    )


def areas(bundle: Bundle) -> np.ndarray:
    """Signed areas, positive for counter-clockwise rings; measured from the first corner."""
    x, y, start = bundle
    owner, before = _owner(start), _before(start)
    x, y = x - x[start[owner]], y - y[start[owner]]
    return np.bincount(owner, x[before] * y - x * y[before], len(start) - 1) / 2


def _boxes(bundle: Bundle) -> tuple[np.ndarray, ...]:
    """Least x, greatest x, least y, greatest y of rings that all have corners."""
    x, y, start = bundle
    return tuple(f.reduceat(v, start[:-1]) for v in (x, y) for f in (np.minimum, np.maximum))


def _emit(start: np.ndarray, stay: np.ndarray, cross: np.ndarray, old: list, new: list) -> Bundle:
    """Corners that stay, and in front of a corner the point where its edge crosses the line."""
    count = stay.astype(np.int64) + cross
    ends = np.concatenate([[0], np.cumsum(count)])
    at, made = ends[:-1], []
    for kept, met in zip(old, new):
        v = np.empty(ends[-1])
        v[at[cross]] = met
        v[(at + cross)[stay]] = kept[stay]
        made.append(v)
    return made[0], made[1], ends[start]


def clip(bundle: Bundle, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> Bundle:
    """The part of each ring in its own half-plane ``a·x + b·y + c >= 0``."""
    x, y, start = bundle
    owner, before = _owner(start), _before(start)
    here = a[owner] * x + b[owner] * y + c[owner]
    there, stay = here[before], here >= 0
    cross = stay != stay[before]
    p, q = np.flatnonzero(cross), before[cross]
    t = there[p] / (there[p] - here[p])
    return _emit(start, stay, cross, [x, y], [x[q] + (x[p] - x[q]) * t, y[q] + (y[p] - y[q]) * t])


def clip_to_convex(rings: Bundle, convex: Bundle) -> Bundle:
    """The part of each ring inside the convex counter-clockwise ring of the same number."""
    x, y, start = convex
    sizes = np.diff(start)
    for k in range(sizes.max(initial=0)):
        has = sizes > k
        p = np.where(has, start[:-1] + k, 0)
        q = np.where(has, start[:-1] + (k + 1) % np.maximum(sizes, 1), 0)
        # A ring without that many edges is not cut: 0 >= 0.
        a, b = np.where(has, y[p] - y[q], 0.0), np.where(has, x[q] - x[p], 0.0)
        rings = clip(rings, a, b, np.where(has, -(a * x[p]) - b * y[p], 0.0))
    return rings


def _side(bundle: Bundle, axis: int, line: np.ndarray, sign: float) -> Bundle:
    """The part of each ring on one side of its line across an axis; new corners lie exactly on it."""
    start = bundle[2]
    u, v = bundle[axis], bundle[1 - axis]
    owner, before = _owner(start), _before(start)
    here = (u - line[owner]) * sign
    there, stay = here[before], here >= 0
    cross = ((here > 0) & (there < 0)) | ((here < 0) & (there > 0))
    p, q = np.flatnonzero(cross), before[cross]
    across = v[q] + (v[p] - v[q]) * (there[p] / (there[p] - here[p]))
    one, two, new = _emit(start, stay, cross, [u, v], [line[owner[p]], across])
    return (one, two, new) if axis == 0 else (two, one, new)


def _tidy(bundle: Bundle) -> Bundle:
    """Without corners that equal the one before, then without those in the middle of a run along
    one grid line; the signed areas stay."""
    x, y, start = bundle
    before = _before(start)
    bundle = x, y, start = _keep(bundle, (x != x[before]) | (y != y[before]))
    before = _before(start)
    after = np.empty_like(before)
    after[before] = np.arange(len(before))
    bends = ((x != x[before]) | (x != x[after])) & ((y != y[before]) | (y != y[after]))
    return _keep(bundle, bends)


def _halve(bundle: Bundle, row: np.ndarray, axis: int, size: float, above: int) -> tuple[Bundle, np.ndarray]:
    """Rings with more than ``above`` corners that reach across the nearest multiple of ``size`` in
    two parts, others as they are. ``row`` says where a ring comes from and goes with its parts."""
    if not len(row):
        return bundle, row
    low, high = _boxes(bundle)[2 * axis : 2 * axis + 2]
    line = np.floor((low + high) / 2 / size + 0.5) * size
    cut = (np.diff(bundle[2]) > above) & (low < line) & (line < high)
    if not cut.any():
        return bundle, row
    wide = _take(bundle, np.flatnonzero(cut))
    parts = [_tidy(_side(wide, axis, line[cut], sign)) for sign in (-1.0, 1.0)]
    out = _join([_take(bundle, np.flatnonzero(~cut)), *parts])
    row = np.concatenate([row[~cut], row[cut], row[cut]])
    some = np.flatnonzero(np.diff(out[2]) > 0)
    return _take(out, some), row[some]


def cut_bundle(
    bundle: Bundle, tile: float, extent: float, corners: int, max_corners: int
) -> tuple[Bundle, np.ndarray]:
    """Rings cut at tile borders by halving, and the number of the ring that each part is of.

    Halving starts at the power of two of ``tile`` that covers the widest ring, then goes on below
    ``tile`` for parts with more than ``max_corners`` corners.
    """
    row = np.arange(len(bundle[2]) - 1)
    if not len(row):
        return bundle, row
    left, right, low, high = _boxes(bundle)
    extent = max(extent, tile, float((right - left).max()), float((high - low).max()))
    corners = max(corners, int(np.diff(bundle[2]).max()))
    coarse = math.ceil(math.log2(extent / tile))
    finer = math.ceil(math.log(corners / max_corners, 4)) + 3 if corners > max_corners else 0
    for level in range(coarse, -finer - 1, -1):
        for axis in (0, 1):
            bundle, row = _halve(bundle, row, axis, tile * 2.0**level, 0 if level >= 0 else max_corners)
    return bundle, row


def read(rings: pa.Array) -> Bundle:
    """A bundle of an Arrow column of ``ARRAY<STRUCT<x, y>>``; a missing ring has no corners, a
    missing coordinate is NaN."""
    sizes = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
    x, y = (
        pc.fill_null(v, math.nan).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        for v in rings.flatten().flatten()
    )
    return x, y, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def write(bundle: Bundle) -> pa.Array:
    x, y, start = bundle
    corners = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), corners)


def _shares(bundle: Bundle, tile: float) -> Iterator[np.ndarray]:
    """The numbers of the rings that have corners, all of them finite, in shares whose parts have
    about ``AT_ONCE`` corners."""
    x, y, start = bundle
    broken = np.bincount(_owner(start), ~(np.isfinite(x) & np.isfinite(y)), len(start) - 1)
    good = np.flatnonzero((np.diff(start) > 0) & (broken == 0))
    if not len(good):
        return
    some = _take(bundle, good)
    left, right, low, high = _boxes(some)
    tiles = ((right - left) / tile + 1) * ((high - low) / tile + 1)
    share = np.cumsum(np.diff(some[2]) + 4 * tiles) // AT_ONCE
    yield from np.split(good, np.flatnonzero(np.diff(share)) + 1)


def tile_cutter(ring: str, names: list[str], tile: float, extent: float, corners: int, max_corners: int):
    """For ``mapInArrow``: one row per part of a ring, with the columns ``names`` of its row, the
    part, its tile, signed area and box, and whether it is its whole tile."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = read(batch.column(ring))
            for share in _shares(rings, tile):
                parts, row = cut_bundle(_take(rings, share), tile, extent, corners, max_corners)
                if not len(row):
                    continue
                area, (left, right, low, high) = areas(parts), _boxes(parts)
                # No ring of four corners in a tile but the tile itself has the tile's area.
                whole = (np.diff(parts[2]) == 4) & (np.abs(area) >= tile * tile * (1 - 1e-13))
                taken = batch.select(names).take(pa.array(share[row]))
                place = [np.floor((a + b) / 2 / tile).astype(np.int64) for a, b in ((left, right), (low, high))]
                made = [write(parts), *map(pa.array, (*place, area, left, right, low, high, whole))]
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, *made],
                    [*names, ring, "tx", "ty", "_area", "_left", "_right", "_low", "_high", "_whole"],
                )

    return cut


def shared_areas(ring: str, convex: str, names: list[str], out: str):
    """For ``mapInArrow``: the signed area that ``ring`` shares with ``convex``, rows without one go.

    A missing ring stands for a part that is its whole tile: the other one's area is shared, with
    the sign of the first. ``_area`` and ``_convex_area`` are the areas of both.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, other = batch.column(ring), batch.column(convex)
            area, convex_area = (batch.column(c).to_numpy() for c in ("_area", "_convex_area"))
            whole, all_of_it = (v.is_null().to_numpy(zero_copy_only=False) for v in (mine, other))
            shared = np.where(all_of_it, area, np.sign(area) * convex_area)
            both = np.flatnonzero(~whole & ~all_of_it)
            if len(both):
                at = pa.array(both)
                shared[both] = areas(clip_to_convex(read(mine.take(at)), read(other.take(at))))
            found = pa.array(np.flatnonzero(shared != 0))
            kept = batch.select(names).take(found)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(shared).take(found)], [*names, out])

    return measure
