"""Per-row measures of lines and polygons stored as arrays (Spark SQL text).

A line is ``pts ARRAY<STRUCT<x,y>>``; a polygon is ``rings
ARRAY<ARRAY<STRUCT<x,y>>>`` (closed rings).  Everything is a higher-order
function evaluated in the JVM, one row at a time: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoqa.functions import crs


def col(sql: str) -> Column:
    return F.expr(sql)


def _seglen(pts: str, i: str = "i") -> str:
    a, b = f"{pts}[{i} - 1]", f"{pts}[{i}]"
    return f"sqrt(cast(({b}.x - {a}.x) * ({b}.x - {a}.x) + ({b}.y - {a}.y) * ({b}.y - {a}.y) AS double))"


def length(pts: str) -> str:
    """Planar length (sum of segment lengths, in vertex order)."""
    return f"aggregate(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), cast(0 AS double), (acc, i) -> acc + {_seglen(pts)})"


def geo_length(pts: str) -> str:
    """Geodesic length in metres of a Mercator line (local metric per segment)."""
    a, b = f"{pts}[i - 1]", f"{pts}[i]"
    d = crs.geo_distance(crs.lon_of(f"{a}.x"), crs.lat_of(f"{a}.y"), crs.lon_of(f"{b}.x"), crs.lat_of(f"{b}.y"))
    return f"aggregate(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), cast(0 AS double), (acc, i) -> acc + {d})"


def interpolate(pts: str, frac: str) -> str:
    """Point at fraction ``frac`` of the length (ST_LineInterpolatePoint):
    the first segment whose running length reaches ``frac * length``."""
    target = f"({frac}) * {length(pts)}"
    a, b = f"{pts}[i - 1]", f"{pts}[i]"
    # the segment length is bound once per step (lambdas get no common-subexpression elimination)
    step = (f"(s, i) -> CASE WHEN s.done THEN s ELSE element_at(transform(array({_seglen(pts)}), sl_ -> "
            f"CASE WHEN s.acc + sl_ >= s.t THEN named_struct('done', true, 't', s.t, 'acc', s.acc + sl_, "
            f"'x', {a}.x + ({b}.x - {a}.x) * (CASE WHEN sl_ = 0 THEN 0D ELSE (s.t - s.acc) / sl_ END), "
            f"'y', {a}.y + ({b}.y - {a}.y) * (CASE WHEN sl_ = 0 THEN 0D ELSE (s.t - s.acc) / sl_ END)) "
            f"ELSE named_struct('done', false, 't', s.t, 'acc', s.acc + sl_, "
            f"'x', cast({b}.x AS double), 'y', cast({b}.y AS double)) END), 1) END")
    init = (f"named_struct('done', false, 't', cast({target} AS double), 'acc', cast(0 AS double), "
            f"'x', cast({pts}[0].x AS double), 'y', cast({pts}[0].y AS double))")
    return (f"aggregate(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), {init}, {step}, "
            f"s -> named_struct('x', s.x, 'y', s.y))")


def centroid(pts: str) -> str:
    """Length-weighted centroid of a line (ST_Centroid of a linestring);
    a zero-length line falls back to the vertex average."""
    a, b = f"{pts}[i - 1]", f"{pts}[i]"
    sx = f"aggregate(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), cast(0 AS double), (acc, i) -> acc + {_seglen(pts)} * ({a}.x + {b}.x) / 2)"
    sy = f"aggregate(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), cast(0 AS double), (acc, i) -> acc + {_seglen(pts)} * ({a}.y + {b}.y) / 2)"
    ax = f"aggregate({pts}, cast(0 AS double), (acc, p) -> acc + p.x) / size({pts})"
    ay = f"aggregate({pts}, cast(0 AS double), (acc, p) -> acc + p.y) / size({pts})"
    L = length(pts)
    return (f"CASE WHEN {L} > 0 THEN named_struct('x', {sx} / {L}, 'y', {sy} / {L}) "
            f"ELSE named_struct('x', {ax}, 'y', {ay}) END")


def substring(pts: str, f0: str, f1: str) -> str:
    """Sub-line between fractions f0 < f1 (ST_LineSubstring): interpolated
    start, the vertices strictly inside, interpolated end."""
    # running lengths built once (same additions, in the same order, as ``interpolate``)
    cum = (f"aggregate(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), array(0D), "
           f"(acc, i) -> concat(acc, array(acc[size(acc) - 1] + {_seglen(pts)})))")

    def at(t: str) -> str:
        """Point at running length t: first segment whose end reaches t."""
        a, b = f"{pts}[k_ - 1]", f"{pts}[k_]"
        sl = _seglen(pts, "k_")
        hit = f"filter(sequence(1, size(c_) - 1), i -> c_[i] >= {t})"
        return (f"element_at(transform(array(coalesce(element_at({hit}, 1), 0)), k_ -> CASE WHEN k_ = 0 THEN "
                f"named_struct('x', cast({pts}[size({pts}) - 1].x AS double), 'y', cast({pts}[size({pts}) - 1].y AS double)) "
                f"ELSE named_struct('x', {a}.x + ({b}.x - {a}.x) * (CASE WHEN {sl} = 0 THEN 0D ELSE ({t} - c_[k_ - 1]) / {sl} END), "
                f"'y', {a}.y + ({b}.y - {a}.y) * (CASE WHEN {sl} = 0 THEN 0D ELSE ({t} - c_[k_ - 1]) / {sl} END)) END), 1)")

    t0, t1 = f"(({f0}) * c_[size(c_) - 1])", f"(({f1}) * c_[size(c_) - 1])"
    inner = (f"transform(filter(sequence(0, size({pts}) - 1), j -> c_[j] > {t0} AND c_[j] < {t1}), "
             f"j -> named_struct('x', cast({pts}[j].x AS double), 'y', cast({pts}[j].y AS double)))")
    first = f"named_struct('x', cast({pts}[0].x AS double), 'y', cast({pts}[0].y AS double))"
    start = f"CASE WHEN size(c_) < 2 THEN {first} ELSE {at(t0)} END"
    end = f"CASE WHEN size(c_) < 2 THEN {first} ELSE {at(t1)} END"
    return f"element_at(transform(array({cum}), c_ -> concat(array({start}), {inner}, array({end}))), 1)"


def bbox(pts: str) -> tuple:
    return (f"array_min(transform({pts}, p -> p.x))", f"array_min(transform({pts}, p -> p.y))",
            f"array_max(transform({pts}, p -> p.x))", f"array_max(transform({pts}, p -> p.y))")


def closest_point(pts: str, px: str, py: str) -> str:
    """Point of the line nearest to (px, py) (ST_ClosestPoint); ties go to
    the first segment.  Returns struct(x, y, d2)."""
    a, b = f"{pts}[i - 1]", f"{pts}[i]"
    l2 = f"(({b}.x - {a}.x) * ({b}.x - {a}.x) + ({b}.y - {a}.y) * ({b}.y - {a}.y))"
    dot = f"((({px}) - {a}.x) * ({b}.x - {a}.x) + (({py}) - {a}.y) * ({b}.y - {a}.y))"
    t = f"(CASE WHEN {l2} = 0 OR {dot} <= 0 THEN 0D WHEN {dot} >= {l2} THEN 1D ELSE cast({dot} AS double) / {l2} END)"
    cx = f"({a}.x + ({b}.x - {a}.x) * {t})"
    cy = f"({a}.y + ({b}.y - {a}.y) * {t})"
    cand = (f"transform(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), i -> named_struct('x', cast({cx} AS double), "
            f"'y', cast({cy} AS double), 'd2', ({cx} - ({px})) * ({cx} - ({px})) + ({cy} - ({py})) * ({cy} - ({py}))))")
    return (f"aggregate({cand}, {cand}[0], (best, c) -> CASE WHEN c.d2 < best.d2 THEN c ELSE best END)")


# ------------------------------------------------------------------ polygons
def _ring_cross_sum(r: str, expr: str) -> str:
    return f"aggregate(filter(sequence(1, greatest(size({r}) - 1, 1)), i -> i < size({r})), cast(0 AS double), (acc, i) -> acc + {expr})"


def area(rings: str) -> str:
    """Planar area, even-odd: |outer| minus holes (rings given with any
    orientation: the first ring is the shell, later rings are holes)."""
    a, b = "r[i - 1]", "r[i]"
    cr = f"({a}.x * {b}.y - {b}.x * {a}.y)"
    ring_area = f"abs({_ring_cross_sum('r', cr)}) / 2"
    return (f"aggregate(transform({rings}, (r, k) -> CASE WHEN k = 0 THEN {ring_area} ELSE -{ring_area} END), "
            f"cast(0 AS double), (acc, v) -> acc + v)")


def polygon_centroid(rings: str) -> str:
    """Area-weighted centroid of the shell minus holes (ST_Centroid)."""
    a, b = "r[i - 1]", "r[i]"
    cr = f"({a}.x * {b}.y - {b}.x * {a}.y)"
    per_ring = (f"transform({rings}, r -> named_struct("
                f"'a', {_ring_cross_sum('r', cr)} / 2, "
                f"'mx', {_ring_cross_sum('r', f'({a}.x + {b}.x) * {cr}')} / 6, "
                f"'my', {_ring_cross_sum('r', f'({a}.y + {b}.y) * {cr}')} / 6))")
    # holes subtract: orient every ring's contribution relative to the shell sign
    tot = (f"aggregate({per_ring}, named_struct('a', cast(0 AS double), 'mx', cast(0 AS double), "
           f"'my', cast(0 AS double), 's', cast(0 AS double)), "
           f"(acc, v) -> CASE WHEN acc.s = 0 THEN named_struct('a', abs(v.a), 'mx', v.mx * signum(v.a), "
           f"'my', v.my * signum(v.a), 's', signum(v.a)) "
           f"ELSE named_struct('a', acc.a - abs(v.a), 'mx', acc.mx - v.mx * signum(v.a), "
           f"'my', acc.my - v.my * signum(v.a), 's', acc.s) END)")
    return f"element_at(transform(array({tot}), t -> named_struct('x', t.mx / t.a, 'y', t.my / t.a)), 1)"


def point_on_surface(rings: str) -> str:
    """Interior point (ST_PointOnSurface): horizontal scan line between the
    vertex ordinates nearest to the bbox centre, midpoint of the widest
    interior interval along it."""
    ys = f"flatten(transform({rings}, r -> transform(r, p -> cast(p.y AS double))))"
    cy = f"((array_min({ys}) + array_max({ys})) / 2)"
    lo = f"array_max(filter(concat({ys}), v -> v <= {cy}))"
    hi = f"coalesce(array_min(filter({ys}, v -> v > {cy})), array_max({ys}))"
    scan = f"(({lo}) + ({hi})) / 2"
    a, b = "r[i - 1]", "r[i]"
    xs = (f"array_sort(flatten(transform({rings}, r -> transform(filter(filter(sequence(1, greatest(size(r) - 1, 1)), i -> i < size(r)), "
          f"i -> ({a}.y > s) <> ({b}.y > s)), "
          f"i -> {a}.x + ({b}.x - {a}.x) * (s - {a}.y) / ({b}.y - {a}.y)))))")
    pairs = (f"transform(sequence(0, cast(size(xs) / 2 AS int) - 1), k -> "
             f"named_struct('w', xs[2 * k + 1] - xs[2 * k], 'x', (xs[2 * k + 1] + xs[2 * k]) / 2))")
    best = (f"aggregate({pairs}, named_struct('w', cast(-1 AS double), 'x', cast(null AS double)), "
            f"(m, p) -> CASE WHEN p.w > m.w THEN p ELSE m END)")
    return (f"element_at(transform(array({scan}), s -> element_at(transform(array({xs}), xs -> "
            f"named_struct('x', {best}.x, 'y', s)), 1)), 1)")


# ------------------------------------------------------ segment vs convex ring
def _halfplanes(cons: list) -> str:
    """Interval of t in [0, 1] where every ``num + t * den >= 0`` holds:
    struct(lo, hi, ok)."""
    lo = ", ".join(f"CASE WHEN ({d}) > 0 THEN -({n}) / ({d}) END" for n, d in cons)
    hi = ", ".join(f"CASE WHEN ({d}) < 0 THEN -({n}) / ({d}) END" for n, d in cons)
    bad = " OR ".join(f"(({d}) = 0 AND ({n}) < 0)" for n, d in cons)
    return (f"named_struct('lo', greatest(0D, {lo}), 'hi', least(1D, {hi}), 'bad', {bad})")


def clip_convex(x1: str, y1: str, x2: str, y2: str, ring: str) -> str:
    """Part of segment (x1,y1)-(x2,y2) inside a counter-clockwise convex
    ring (Cyrus-Beck): struct(lo, hi) of the parameter; empty when lo > hi."""
    e1, e2 = f"{ring}[i - 1]", f"{ring}[i]"
    nx, ny = f"(-({e2}.y - {e1}.y))", f"({e2}.x - {e1}.x)"
    num = f"({nx} * (({x1}) - {e1}.x) + {ny} * (({y1}) - {e1}.y))"
    den = f"({nx} * (({x2}) - ({x1})) + {ny} * (({y2}) - ({y1})))"
    step = (f"(s, i) -> named_struct("
            f"'lo', CASE WHEN {den} > 0 THEN greatest(s.lo, -{num} / {den}) ELSE s.lo END, "
            f"'hi', CASE WHEN {den} < 0 THEN least(s.hi, -{num} / {den}) ELSE s.hi END, "
            f"'bad', s.bad OR ({den} = 0 AND {num} < 0))")
    idx = f"filter(sequence(1, greatest(size({ring}) - 1, 1)), i -> i < size({ring}))"
    return (f"aggregate({idx}, named_struct('lo', 0D, 'hi', 1D, 'bad', false), {step}, "
            f"s -> CASE WHEN s.bad THEN named_struct('lo', 1D, 'hi', 0D) ELSE named_struct('lo', s.lo, 'hi', s.hi) END)")


def clip_buffer(x1: str, y1: str, x2: str, y2: str, ring: str, r: float, with_interior: str) -> str:
    """Part of the segment within ``r`` of a convex ring (the ring buffered
    by r): the union of the ring itself (when ``with_interior`` is true),
    a rectangle along every edge and a disc at every vertex.  The buffer is
    convex, so the union is one interval: [min lo, max hi] of the pieces."""
    vx, vy = f"(cast(({x2}) - ({x1}) AS double))", f"(cast(({y2}) - ({y1}) AS double))"
    # per-edge quantities bound once in a struct (lambdas get no common-subexpression elimination)
    e1, e2 = "rb_[j - 1]", "rb_[j]"
    ux, uy = f"cast({e2}.x - {e1}.x AS double)", f"cast({e2}.y - {e1}.y AS double)"
    edge = (f"named_struct('ux', {ux}, 'uy', {uy}, 'L', sqrt({ux} * {ux} + {uy} * {uy}), "
            f"'ax', cast(({x1}) - {e1}.x AS double), 'ay', cast(({y1}) - {e1}.y AS double), "
            f"'bx', cast({e2}.x - ({x1}) AS double), 'by', cast({e2}.y - ({y1}) AS double))")
    an = "((e_.ax * -e_.uy + e_.ay * e_.ux) / e_.L)"
    vn = f"(({vx} * -e_.uy + {vy} * e_.ux) / e_.L)"
    vu = f"({vx} * e_.ux + {vy} * e_.uy)"
    rect = _halfplanes([("(e_.ax * e_.ux + e_.ay * e_.uy)", vu),
                        ("(e_.bx * e_.ux + e_.by * e_.uy)", f"(-{vu})"),
                        (f"({r!r} - {an})", f"(-{vn})"),
                        (f"({r!r} + {an})", f"({vn})")])
    A = f"({vx} * {vx} + {vy} * {vy})"
    B = f"(2 * ({vx} * e_.ax + {vy} * e_.ay))"
    C = f"(e_.ax * e_.ax + e_.ay * e_.ay - {r!r} * {r!r})"
    disc = (f"element_at(transform(array(named_struct('A', {A}, 'B', {B}, 'C', {C})), q_ -> "
            f"CASE WHEN q_.A = 0 THEN (CASE WHEN q_.C <= 0 THEN named_struct('lo', 0D, 'hi', 1D, 'bad', false) "
            f"ELSE named_struct('lo', 1D, 'hi', 0D, 'bad', true) END) "
            f"WHEN q_.B * q_.B - 4 * q_.A * q_.C < 0 THEN named_struct('lo', 1D, 'hi', 0D, 'bad', true) "
            f"ELSE named_struct('lo', greatest(0D, (-q_.B - sqrt(q_.B * q_.B - 4 * q_.A * q_.C)) / (2 * q_.A)), "
            f"'hi', least(1D, (-q_.B + sqrt(q_.B * q_.B - 4 * q_.A * q_.C)) / (2 * q_.A)), 'bad', false) END), 1)")
    pieces = (f"flatten(transform(filter(sequence(1, greatest(size(rb_) - 1, 1)), j -> j < size(rb_)), "
              f"j -> element_at(transform(array({edge}), e_ -> "
              f"CASE WHEN e_.L = 0 THEN array({disc}) ELSE array({rect}, {disc}) END), 1)))")
    inner = clip_convex(x1, y1, x2, y2, "rb_")
    # lambdas get no common-subexpression elimination: bind each array once
    allp = (f"concat({pieces}, filter(transform(array({inner}), c_ -> named_struct('lo', c_.lo, 'hi', c_.hi, "
            f"'bad', false)), p -> {with_interior}))")
    good = f"filter({allp}, p -> NOT p.bad AND p.lo <= p.hi)"
    body = (f"element_at(transform(array({good}), g_ -> CASE WHEN size(g_) = 0 THEN named_struct('lo', 1D, 'hi', 0D) "
            f"ELSE named_struct('lo', array_min(transform(g_, p -> p.lo)), 'hi', array_max(transform(g_, p -> p.hi))) END), 1)")
    return f"element_at(transform(array({ring}), rb_ -> {body}), 1)"


def rings_to_segments(rings: str) -> str:
    """Boundary as an array of struct(ring, seg, x1, y1, x2, y2) (ST_Boundary)."""
    return (f"flatten(transform({rings}, (r, ri) -> transform(filter(sequence(1, greatest(size(r) - 1, 1)), i -> i < size(r)), "
            f"i -> named_struct('ring', ri, 'seg', i, 'x1', r[i - 1].x, 'y1', r[i - 1].y, "
            f"'x2', r[i].x, 'y2', r[i].y))))")


def line_to_segments(pts: str) -> str:
    return (f"transform(filter(sequence(1, greatest(size({pts}) - 1, 1)), i -> i < size({pts})), i -> named_struct('seg', i, "
            f"'x1', {pts}[i - 1].x, 'y1', {pts}[i - 1].y, 'x2', {pts}[i].x, 'y2', {pts}[i].y))")
