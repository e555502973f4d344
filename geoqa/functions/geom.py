"""Planar geometry predicates and measures as SQL expression text.

Every function takes SQL expressions (usually column names such as ``l.x``)
and returns SQL expression text.  The text runs unchanged in Spark SQL
(wrapped with :func:`col`) and in other ANSI engines, so the brute-force
oracles in ``geoqa.plans`` share the exact arithmetic of the Spark plans.

Predicates are written so that integer-valued inputs give exact answers:
distance tests compare squared quantities (``cross^2 <= d^2 * len^2``)
instead of dividing, and orientation tests use signs.  Doubles with integer
values stay exact up to 2**53, which covers Mercator metres.

Geometries are plain columns:

* point    ``x, y``
* segment  ``x1, y1, x2, y2`` (one row per consecutive vertex pair)
* box      ``xmin, ymin, xmax, ymax``
* polygon  ``rings ARRAY<ARRAY<STRUCT<x,y>>>`` closed rings, even-odd rule
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(sql: str) -> Column:
    """Wrap expression text as a Spark column."""
    return F.expr(sql)


def _sq(a: str) -> str:
    return f"(({a})*({a}))"


# --------------------------------------------------------------- point/point
def pt_pt_d2(ax: str, ay: str, bx: str, by: str) -> str:
    return f"({_sq(f'({ax})-({bx})')}+{_sq(f'({ay})-({by})')})"


def pt_pt_within(ax, ay, bx, by, d, op: str = "<=") -> str:
    return f"({pt_pt_d2(ax, ay, bx, by)} {op} {_sq(d)})"


# ------------------------------------------------------------- point/segment
def _dot(px, py, x1, y1, x2, y2) -> str:
    return f"((({px})-({x1}))*(({x2})-({x1}))+(({py})-({y1}))*(({y2})-({y1})))"


def _len2(x1, y1, x2, y2) -> str:
    return pt_pt_d2(x1, y1, x2, y2)


def cross(px, py, x1, y1, x2, y2) -> str:
    """(b-a) x (p-a): >0 when p is left of a->b."""
    return f"((({x2})-({x1}))*(({py})-({y1}))-(({y2})-({y1}))*(({px})-({x1})))"


def pt_seg_d2(px, py, x1, y1, x2, y2) -> str:
    """Squared distance point-segment (double)."""
    dot = _dot(px, py, x1, y1, x2, y2)
    l2 = _len2(x1, y1, x2, y2)
    cr = cross(px, py, x1, y1, x2, y2)
    return (f"(CASE WHEN {dot} <= 0 THEN {pt_pt_d2(px, py, x1, y1)} "
            f"WHEN {dot} >= {l2} THEN {pt_pt_d2(px, py, x2, y2)} "
            f"ELSE {_sq(cr)} / ({l2}) END)")


def pt_seg_within(px, py, x1, y1, x2, y2, d, op: str = "<=") -> str:
    """Exact test distance(point, segment) <op> d (no division)."""
    dot = _dot(px, py, x1, y1, x2, y2)
    l2 = _len2(x1, y1, x2, y2)
    cr = cross(px, py, x1, y1, x2, y2)
    return (f"(CASE WHEN {dot} <= 0 THEN {pt_pt_d2(px, py, x1, y1)} {op} {_sq(d)} "
            f"WHEN {dot} >= {l2} THEN {pt_pt_d2(px, py, x2, y2)} {op} {_sq(d)} "
            f"ELSE {_sq(cr)} {op} {_sq(d)} * ({l2}) END)")


def closest_t(px, py, x1, y1, x2, y2) -> str:
    """Parameter in [0,1] of the point of a segment closest to p."""
    dot = _dot(px, py, x1, y1, x2, y2)
    l2 = _len2(x1, y1, x2, y2)
    return (f"(CASE WHEN {l2} = 0 OR {dot} <= 0 THEN 0.0 WHEN {dot} >= {l2} THEN 1.0 "
            f"ELSE cast({dot} AS double) / ({l2}) END)")


# ----------------------------------------------------------------- point/box
def pt_box_d2(px, py, xmin, ymin, xmax, ymax) -> str:
    dx = f"greatest(({xmin})-({px}), 0, ({px})-({xmax}))"
    dy = f"greatest(({ymin})-({py}), 0, ({py})-({ymax}))"
    return f"({_sq(dx)}+{_sq(dy)})"


def pt_box_within(px, py, xmin, ymin, xmax, ymax, d, op: str = "<=") -> str:
    return f"({pt_box_d2(px, py, xmin, ymin, xmax, ymax)} {op} {_sq(d)})"


def pt_in_box(px, py, xmin, ymin, xmax, ymax, boundary: bool = True) -> str:
    o = "<=" if boundary else "<"
    return f"(({xmin}) {o} ({px}) AND ({px}) {o} ({xmax}) AND ({ymin}) {o} ({py}) AND ({py}) {o} ({ymax}))"


# ------------------------------------------------------------------ box/box
def box_box_d2(a: tuple, b: tuple) -> str:
    axmin, aymin, axmax, aymax = a
    bxmin, bymin, bxmax, bymax = b
    gx = f"greatest(({bxmin})-({axmax}), ({axmin})-({bxmax}), 0)"
    gy = f"greatest(({bymin})-({aymax}), ({aymin})-({bymax}), 0)"
    return f"({_sq(gx)}+{_sq(gy)})"


def box_overlap(a: tuple, b: tuple, margin: str = "0") -> str:
    """Bounding boxes meet (``&&``), optionally after expanding ``a`` by margin."""
    axmin, aymin, axmax, aymax = a
    bxmin, bymin, bxmax, bymax = b
    return (f"(({axmin})-({margin}) <= ({bxmax}) AND ({bxmin}) <= ({axmax})+({margin}) AND "
            f"({aymin})-({margin}) <= ({bymax}) AND ({bymin}) <= ({aymax})+({margin}))")


# -------------------------------------------------------------- segment/seg
def seg_intersects(a: tuple, b: tuple) -> str:
    ax1, ay1, ax2, ay2 = a
    bx1, by1, bx2, by2 = b
    o1 = f"sign({cross(bx1, by1, ax1, ay1, ax2, ay2)})"
    o2 = f"sign({cross(bx2, by2, ax1, ay1, ax2, ay2)})"
    o3 = f"sign({cross(ax1, ay1, bx1, by1, bx2, by2)})"
    o4 = f"sign({cross(ax2, ay2, bx1, by1, bx2, by2)})"
    bb = box_overlap(seg_bbox(*a), seg_bbox(*b))
    return f"({bb} AND {o1}*{o2} <= 0 AND {o3}*{o4} <= 0)"


def seg_bbox(x1, y1, x2, y2) -> tuple:
    return (f"least({x1},{x2})", f"least({y1},{y2})", f"greatest({x1},{x2})", f"greatest({y1},{y2})")


def seg_seg_within(a: tuple, b: tuple, d, op: str = "<=") -> str:
    ax1, ay1, ax2, ay2 = a
    bx1, by1, bx2, by2 = b
    parts = [seg_intersects(a, b),
             pt_seg_within(ax1, ay1, bx1, by1, bx2, by2, d, op),
             pt_seg_within(ax2, ay2, bx1, by1, bx2, by2, d, op),
             pt_seg_within(bx1, by1, ax1, ay1, ax2, ay2, d, op),
             pt_seg_within(bx2, by2, ax1, ay1, ax2, ay2, d, op)]
    return "(" + " OR ".join(parts) + ")"


def seg_seg_d2(a: tuple, b: tuple) -> str:
    ax1, ay1, ax2, ay2 = a
    bx1, by1, bx2, by2 = b
    m = (f"least({pt_seg_d2(ax1, ay1, bx1, by1, bx2, by2)}, {pt_seg_d2(ax2, ay2, bx1, by1, bx2, by2)}, "
         f"{pt_seg_d2(bx1, by1, ax1, ay1, ax2, ay2)}, {pt_seg_d2(bx2, by2, ax1, ay1, ax2, ay2)})")
    return f"(CASE WHEN {seg_intersects(a, b)} THEN 0.0 ELSE {m} END)"


# -------------------------------------------------------------- segment/box
def _corners(box: tuple) -> list:
    xmin, ymin, xmax, ymax = box
    return [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)]


def seg_intersects_box(s: tuple, box: tuple) -> str:
    """Separating-axis test: bbox overlap and corners not all strictly on one side."""
    x1, y1, x2, y2 = s
    signs = [f"sign({cross(cx, cy, x1, y1, x2, y2)})" for cx, cy in _corners(box)]
    allpos = " AND ".join(f"{g} > 0" for g in signs)
    allneg = " AND ".join(f"{g} < 0" for g in signs)
    return f"({box_overlap(seg_bbox(*s), box)} AND NOT (({allpos}) OR ({allneg})))"


def seg_box_within(s: tuple, box: tuple, d, op: str = "<=") -> str:
    x1, y1, x2, y2 = s
    parts = [seg_intersects_box(s, box),
             pt_box_within(x1, y1, *box, d, op),
             pt_box_within(x2, y2, *box, d, op)]
    parts += [pt_seg_within(cx, cy, x1, y1, x2, y2, d, op) for cx, cy in _corners(box)]
    return "(" + " OR ".join(parts) + ")"


def seg_box_d2(s: tuple, box: tuple) -> str:
    x1, y1, x2, y2 = s
    terms = [pt_box_d2(x1, y1, *box), pt_box_d2(x2, y2, *box)]
    terms += [pt_seg_d2(cx, cy, x1, y1, x2, y2) for cx, cy in _corners(box)]
    return f"(CASE WHEN {seg_intersects_box(s, box)} THEN 0.0 ELSE least({', '.join(terms)}) END)"


# ---------------------------------------------------------------- space-filling order
def zorder(x: str, y: str, unit: float = 1.0) -> str:
    """Spark SQL: place of a point on the Z-shaped curve through a grid of ``unit`` (31 bits each, from -2^30 units on).
    Near places are mostly near on the curve, so files sorted by it have small bounding boxes."""
    masks = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
    steps = ", ".join(f"named_struct('k', {k}, 'm', {m}L)" for k, m in masks)
    number = lambda v: f"(least(greatest(cast(floor(cast({v} AS double) / {float(unit)}) AS bigint) + {1 << 30}L, 0L), {(1 << 31) - 1}L))"
    spread = lambda v: f"aggregate(array({steps}), {number(v)}, (z_, s_) -> (z_ | shiftleft(z_, s_.k)) & s_.m)"
    return f"({spread(x)} | shiftleft({spread(y)}, 1))"


# ------------------------------------------------------------------ polygons
def box_rings(xmin, ymin, xmax, ymax) -> str:
    """Rectangle as a one-ring polygon (counter-clockwise, closed)."""
    p = lambda x, y: f"named_struct('x', {x}, 'y', {y})"
    return (f"array(array({p(xmin, ymin)}, {p(xmax, ymin)}, {p(xmax, ymax)}, "
            f"{p(xmin, ymax)}, {p(xmin, ymin)}))")


def pt_on_boundary(px, py, rings: str) -> str:
    """Point lies on an edge of any ring (exact for integer coordinates)."""
    a, b = "rg_[i_-1]", "rg_[i_]"
    on = (f"({cross(px, py, a + '.x', a + '.y', b + '.x', b + '.y')} = 0 AND "
          f"least({a}.x,{b}.x) <= ({px}) AND ({px}) <= greatest({a}.x,{b}.x) AND "
          f"least({a}.y,{b}.y) <= ({py}) AND ({py}) <= greatest({a}.y,{b}.y))")
    return f"exists({rings}, rg_ -> exists(filter(sequence(1, greatest(size(rg_) - 1, 1)), i_ -> i_ < size(rg_)), i_ -> {on}))"


def pt_crossings(px, py, rings: str) -> str:
    """Number of ring edges crossed by the ray from p towards +x (even-odd rule).

    ``x_int > px`` is tested as a sign product, so no division is needed.
    """
    a, b = "rg_[i_-1]", "rg_[i_]"
    straddle = f"(({a}.y > ({py})) <> ({b}.y > ({py})))"
    right = (f"((({b}.x - {a}.x) * (({py}) - {a}.y) - (({px}) - {a}.x) * ({b}.y - {a}.y)) "
             f"* sign({b}.y - {a}.y) > 0)")
    edge = f"CASE WHEN {straddle} AND {right} THEN 1 ELSE 0 END"
    return (f"aggregate({rings}, 0, (acc_, rg_) -> acc_ + "
            f"aggregate(filter(sequence(1, greatest(size(rg_) - 1, 1)), i_ -> i_ < size(rg_)), 0, (n_, i_) -> n_ + {edge}))")


def pt_in_polygon(px, py, rings: str, boundary: bool = True) -> str:
    """``boundary=True``: covers / intersects (edge counts as inside);
    ``False``: strict contains."""
    inside = f"({pt_crossings(px, py, rings)} % 2 = 1)"
    if boundary:
        return f"({pt_on_boundary(px, py, rings)} OR {inside})"
    return f"(NOT {pt_on_boundary(px, py, rings)} AND {inside})"


def rings_bbox(rings: str) -> tuple:
    xs = f"flatten(transform({rings}, r -> transform(r, p -> p.x)))"
    ys = f"flatten(transform({rings}, r -> transform(r, p -> p.y)))"
    return (f"array_min({xs})", f"array_min({ys})", f"array_max({xs})", f"array_max({ys})")
