"""Checking-engine SQL for the grid algebra, written from its definition (nearest hexagon centre)."""

from __future__ import annotations

import math

ROOT3 = math.sqrt(3.0)
HALF = 1 << 28


def num(value: float) -> str:
    """A literal the checking engine reads as DOUBLE."""
    text = repr(float(value))
    return text if "e" in text else text + "e0"


def side(res: int) -> float:
    return 533.7 * 7.0 ** ((8 - res) / 2)


def pack(q: str, r: str, res: int) -> str:
    return (
        f"(CAST({res} AS BIGINT) * 288230376151711744 + CAST({q} + {HALF} AS BIGINT) * 536870912"
        f" + CAST({r} + {HALF} AS BIGINT))"
    )


def q_of(cell: str) -> str:
    return f"((({cell}) >> 29) & 536870911) - {HALF}"


def r_of(cell: str) -> str:
    return f"(({cell}) & 536870911) - {HALF}"


def cell_items(x: str, y: str, res: int, out: str) -> str:
    """Select items that end in ``out``: fractional axial coordinates, cube-rounded."""
    turned = res % 2 == 1
    s = num(side(res + 1 if turned else res))
    p = f"_{out}"
    a, b = f"({x} * {num(ROOT3 / 3)} - {y} / 3) / {s}", f"({y} * {num(2 / 3)}) / {s}"
    items = [f"{a} AS {p}a", f"{b} AS {p}b"]
    if turned:
        items += [f"(3 * {p}a + {p}b) / 7 AS {p}qf", f"(2 * {p}b - {p}a) / 7 AS {p}rf"]
    else:
        items += [f"{p}a AS {p}qf", f"{p}b AS {p}rf"]
    items += [
        f"floor({p}qf + 0.5) AS {p}q0",
        f"floor({p}rf + 0.5) AS {p}r0",
        f"floor(0.5 - {p}qf - {p}rf) AS {p}s0",
        f"abs({p}q0 - {p}qf) AS {p}dq",
        f"abs({p}r0 - {p}rf) AS {p}dr",
        f"abs({p}s0 + {p}qf + {p}rf) AS {p}ds",
        f"CASE WHEN {p}dq > {p}dr AND {p}dq > {p}ds THEN -{p}r0 - {p}s0 ELSE {p}q0 END AS {p}q",
        f"CASE WHEN NOT ({p}dq > {p}dr AND {p}dq > {p}ds) AND {p}dr > {p}ds"
        f" THEN -{p}q0 - {p}s0 ELSE {p}r0 END AS {p}r",
        f"{pack(p + 'q', p + 'r', res)} AS {out}",
    ]
    return ", ".join(items)


def parent_items(cell: str, from_res: int, to_res: int, out: str) -> str:
    """Select items that end in ``out``: the ancestor, one level at a time."""
    p = f"_{out}"
    items = [f"{q_of(cell)} AS {p}q{from_res}", f"{r_of(cell)} AS {p}r{from_res}"]
    for level in range(from_res, to_res, -1):
        q, r = f"{p}q{level}", f"{p}r{level}"
        up = (f"3 * {q} + {r}", f"2 * {r} - {q}") if level % 2 == 0 else (f"2 * {q} - {r}", f"{q} + 3 * {r}")
        items += [
            f"CAST(floor(({up[0]} + 3) / 7.0) AS BIGINT) AS {p}q{level - 1}",
            f"CAST(floor(({up[1]} + 3) / 7.0) AS BIGINT) AS {p}r{level - 1}",
        ]
    items.append(f"{pack(f'{p}q{to_res}', f'{p}r{to_res}', to_res)} AS {out}")
    return ", ".join(items)


def center_exprs(cell: str, res: int) -> tuple[str, str]:
    q, r, lattice = f"({q_of(cell)})", f"({r_of(cell)})", res
    if res % 2:
        q, r, lattice = f"(2 * {q} - {r})", f"({q} + 3 * {r})", res + 1
    s = num(side(lattice))
    return f"({q} * {num(ROOT3)} + {r} * {num(ROOT3 / 2)}) * {s}", f"{r} * 1.5e0 * {s}"


def _qs(s: str, e: str) -> str:
    return f"((1 - {e}*{e}) * ({s} / (1 - {e}*{e}*{s}*{s}) - ln((1 - {e}*{s}) / (1 + {e}*{s})) / (2*{e})))"


def _ms(lat: str, e: str) -> str:
    return f"(cos({lat}) / sqrt(1 - {e}*{e}*sin({lat})*sin({lat})))"


def _cone(lat: str) -> str:
    return f"(tan(pi()/4 - ({lat})/2) / pow((1 - e2*sin({lat})) / (1 + e2*sin({lat})), e2/2))"


_ONE, _TWO, _ZERO, _BASE = (f"radians({v}e0)" for v in (29.5, 45.5, 23, 50))
# One row with what both cones need, worked out in SQL from the published formulas and parameters:
# nothing here comes from the library. e1, n, c, r0 are the equal-area cone's, e2, m, k the other's.
CONES = f"""(SELECT *, 6378137e0 * sqrt(c - n * {_qs(f'sin({_ZERO})', 'e1')}) / n AS r0,
    sin({_BASE}) AS m, 6378137e0 * {_ms(_BASE, 'e2')} / (sin({_BASE}) * pow({_cone(_BASE)}, sin({_BASE}))) AS k
    FROM (SELECT *, {_ms(_ONE, 'e1')}*{_ms(_ONE, 'e1')} + n * {_qs(f'sin({_ONE})', 'e1')} AS c
    FROM (SELECT *, ({_ms(_ONE, 'e1')}*{_ms(_ONE, 'e1')} - {_ms(_TWO, 'e1')}*{_ms(_TWO, 'e1')}) / ({_qs(f'sin({_TWO})', 'e1')} - {_qs(f'sin({_ONE})', 'e1')}) AS n
    FROM (SELECT sqrt(2 / 298.257222101e0 - 1 / (298.257222101e0 * 298.257222101e0)) AS e1,
    sqrt(2 / 298.257223563e0 - 1 / (298.257223563e0 * 298.257223563e0)) AS e2))))"""
_CONE_NAMES = "e1, e2, n, c, r0, m, k"


def with_albers(source: str, lon: str = "lon", lat: str = "lat") -> str:
    """``source`` with the equal-area metres ``x`` and ``y`` of its degrees."""
    rho = f"6378137e0 * sqrt(c - n * {_qs(f'sin(radians({lat}))', 'e1')}) / n AS arho"
    xy = f"arho * sin(n * radians({lon} + 96)) AS x, r0 - arho * cos(n * radians({lon} + 96)) AS y"
    return f"(SELECT * EXCLUDE ({_CONE_NAMES}, arho), {xy} FROM (SELECT *, {rho} FROM {source}, {CONES}))"


def with_lambert(source: str, lat: str, turn: str, out: tuple[str, str]) -> str:
    """``source``, already joined with CONES, with metres in the weather cone. ``lat`` and ``turn``
    (the longitude from the cone's meridian) are in radians."""
    place = f"""5632642.22547e0 + k * pow({_cone(lat)}, m) * sin(m * {turn}) AS {out[0]},
        4612545.65137e0 + k * pow({_cone(_BASE)}, m) - k * pow({_cone(lat)}, m) * cos(m * {turn}) AS {out[1]}"""
    return f"(SELECT *, {place} FROM {source})"


def with_weather_cell(source: str, x: str, y: str, out: str = "weather_cell") -> str:
    """``source`` (a table or a bracketed query) with the weather raster's cell under each point.

    Equal-area metres go to degrees by iterating the latitude, degrees to the weather cone, and the
    cone's metres to the raster cell. One nested query per step, as names used often would otherwise
    be written out again and again.
    """
    steps = [
        f"sqrt({x}*{x} + (r0 - {y})*(r0 - {y})) AS wrho",
        f"(c - wrho*wrho*n*n / (6378137e0 * 6378137e0)) / n AS wq, -96 + degrees(atan2({x}, r0 - {y}) / n) AS wlon",
        "asin(wq / 2) AS wf",
    ]
    refine = """wf + (1 - e1*e1*sin(wf)*sin(wf)) * (1 - e1*e1*sin(wf)*sin(wf)) / (2*cos(wf)) * (wq / (1 - e1*e1)
        - sin(wf) / (1 - e1*e1*sin(wf)*sin(wf)) + ln((1 - e1*sin(wf)) / (1 + e1*sin(wf))) / (2*e1)) AS wf"""
    cell = f"""CASE WHEN wpx BETWEEN -16231.49e0 AND 11313351e0 AND wpy BETWEEN -16231.5e0 AND 8976020e0 THEN
        CAST((CASE WHEN wpy = -16231.5e0 THEN 276 ELSE floor((8976020e0 - wpy) / ((8976020e0 + 16231.5e0) / 277)) END) * 349
        + (CASE WHEN wpx = 11313351e0 THEN 348 ELSE floor((wpx + 16231.49e0) / ((11313351e0 + 16231.49e0) / 349)) END) + 1
        AS BIGINT) END AS {out}"""
    text = f"(SELECT * FROM {source}, {CONES})"
    for step in steps:
        text = f"(SELECT *, {step} FROM {text})"
    for _ in range(6):
        text = f"(SELECT * EXCLUDE (wf), {refine} FROM {text})"
    text = with_lambert(text, "wf", "radians(wlon + 107)", ("wpx", "wpy"))
    return f"(SELECT * EXCLUDE ({_CONE_NAMES}, wrho, wq, wlon, wf, wpx, wpy), {cell} FROM {text})"


def hexagon_meets_rectangle(x: str, y: str, res: int) -> str:
    """Whether the hexagon of an even resolution around a centre shares a point with the rectangle
    xmin..xmax, ymin..ymax: no axis of either shape separates them."""
    s = side(res)
    a, root = num(s * ROOT3 / 2), num(ROOT3 / 2)
    tests = [
        f"{x} + {a} >= xmin AND {x} - {a} <= xmax",
        f"{y} + {num(s)} >= ymin AND {y} - {num(s)} <= ymax",
    ]
    reach = f"({a} + (xmax - xmin) / 4 + (ymax - ymin) / 2 * {root})"
    for sign in ("+", "-"):
        tests.append(f"abs(({x} - (xmin + xmax) / 2) / 2 {sign} ({y} - (ymin + ymax) / 2) * {root}) <= {reach}")
    return " AND ".join(tests)


def disk(k: int) -> str:
    """A query for all (dq, dr, d) within ``k`` steps."""
    return (
        f"SELECT a AS dq, b AS dr, greatest(abs(a), abs(b), abs(a + b)) AS d "
        f"FROM range(-{k}, {k + 1}) s(a), range(-{k}, {k + 1}) t(b) WHERE abs(a + b) <= {k}"
    )
