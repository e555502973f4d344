"""Spatial joins as grid-cell equi-joins with an exact residual predicate.

Plan shape (for every variant)::

    left  --(cell of point | cells of bbox)------------\\
                                                        >-- equi-join on (cx, cy)
    right --(cells of geometry expanded by distance)---/     + exact residual

Catalyst plans a sort-merge (or, when AQE measures a small side, broadcast
hash) join on the cell key; AQE splits skewed cells.  The left side is never
replicated when it is made of points, so point anti/semi joins need no
de-duplication.  Other shapes stand on grids of several levels, each on the one
of its size; a pair is kept only in the lowest cell both covers share, so no
``distinct`` shuffle is needed either.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoqa.functions import crs
from geoqa.functions import geom as G
from geoqa.operators import grid
from geoqa.session import ensure_checkpoint_dir


# ------------------------------------------------------------ geometry specs
@dataclass(frozen=True)
class Point:
    x: str = "x"
    y: str = "y"

    def cols(self):
        return (self.x, self.y)


@dataclass(frozen=True)
class Segment:
    x1: str = "x1"
    y1: str = "y1"
    x2: str = "x2"
    y2: str = "y2"

    def cols(self):
        return (self.x1, self.y1, self.x2, self.y2)


@dataclass(frozen=True)
class Box:
    xmin: str = "xmin"
    ymin: str = "ymin"
    xmax: str = "xmax"
    ymax: str = "ymax"

    def cols(self):
        return (self.xmin, self.ymin, self.xmax, self.ymax)


@dataclass(frozen=True)
class Polygon:
    """Closed rings; bbox columns are optional (computed from the rings)."""
    rings: str = "rings"
    bbox: tuple | None = None

    def cols(self):
        return (self.rings,) + (tuple(self.bbox) if self.bbox else ())


def _q(p: str, cols) -> tuple:
    return tuple(f"{p}.`{c}`" for c in cols)


def bbox_of(g, p: str) -> tuple:
    if isinstance(g, Point):
        x, y = _q(p, g.cols())
        return (x, y, x, y)
    if isinstance(g, Segment):
        return G.seg_bbox(*_q(p, g.cols()))
    if isinstance(g, Box):
        return _q(p, g.cols())
    if isinstance(g, Polygon):
        return _q(p, g.bbox) if g.bbox else G.rings_bbox(f"{p}.`{g.rings}`")
    raise TypeError(g)


def within_sql(lg, rg, d, op: str = "<=", lp: str = "l", rp: str = "r") -> str:
    """Exact ``distance(left, right) <op> d`` for the supported pairs."""
    d = str(d)
    L, R = _q(lp, lg.cols()), _q(rp, rg.cols())
    kinds = (type(lg), type(rg))
    if kinds == (Point, Point):
        return G.pt_pt_within(*L, *R, d, op)
    if kinds == (Point, Segment):
        return G.pt_seg_within(*L, *R, d, op)
    if kinds == (Segment, Point):
        return G.pt_seg_within(*R, *L, d, op)
    if kinds == (Point, Box):
        return G.pt_box_within(*L, *R, d, op)
    if kinds == (Box, Point):
        return G.pt_box_within(*R, *L, d, op)
    if kinds == (Segment, Segment):
        return G.seg_seg_within(L, R, d, op)
    if kinds == (Segment, Box):
        return G.seg_box_within(L, R, d, op)
    if kinds == (Box, Segment):
        return G.seg_box_within(R, L, d, op)
    if kinds == (Box, Box):
        return f"({G.box_box_d2(L, R)} {op} ({d})*({d}))"
    if type(lg) is Polygon:
        return _polygon_within(lg, lp, rg, rp, d, op)
    if type(rg) is Polygon:
        return _polygon_within(rg, rp, lg, lp, d, op)
    raise TypeError(f"no distance predicate for {kinds}")


def _polygon_within(pg, pp: str, g, gp: str, d: str, op: str) -> str:
    """Exact ``distance(polygon, g) <op> d``: one contains a point of the other, or an edge is near enough.
    The bounding boxes are compared first."""
    rings = f"{pp}.`{pg.rings}`"
    pre = G.box_overlap(bbox_of(pg, pp), bbox_of(g, gp), d)
    e = ("e.x1", "e.y1", "e.x2", "e.y2")
    inside = lambda x, y: G.pt_in_polygon(x, y, rings) if op == "<=" or d != "0" else "false"
    if type(g) is Point:
        x, y = _q(gp, g.cols())
        return f"({pre} AND ({inside(x, y)} OR exists({_edges(rings)}, e -> {G.pt_seg_within(x, y, *e, d, op)})))"
    if type(g) is Segment:
        s = _q(gp, g.cols())
        return f"({pre} AND ({inside(s[0], s[1])} OR exists({_edges(rings)}, e -> {G.seg_seg_within(e, s, d, op)})))"
    if type(g) is Box:
        box = _q(gp, g.cols())
        in_box = f"exists(flatten({rings}), v -> {G.pt_in_box('v.x', 'v.y', *box)})"
        return f"({pre} AND ({inside(box[0], box[1])} OR {in_box} OR exists({_edges(rings)}, e -> {G.seg_box_within(e, box, d, op)})))"
    other, f = f"{gp}.`{g.rings}`", ("f.x1", "f.y1", "f.x2", "f.y2")
    nested = f"{_some_vertex_in(other, rings)} OR {_some_vertex_in(rings, other)}"
    return f"({pre} AND ({nested} OR exists({_edges(rings)}, e -> exists({_edges(other)}, f -> {G.seg_seg_within(e, f, d, op)}))))"


def _some_vertex_in(a_rings: str, b_rings: str) -> str:
    """The first vertex of some ring of ``a`` lies in ``b`` (a part without crossing edges is inside as a whole)."""
    return f"exists({a_rings}, ra_ -> {G.pt_in_polygon('ra_[0].x', 'ra_[0].y', b_rings)})"


def dist2_sql(lg, rg, lp: str = "l", rp: str = "r") -> str:
    """Squared planar distance for the supported pairs (double)."""
    L, R = _q(lp, lg.cols()), _q(rp, rg.cols())
    kinds = (type(lg), type(rg))
    if kinds == (Point, Point):
        return G.pt_pt_d2(*L, *R)
    if kinds == (Point, Segment):
        return G.pt_seg_d2(*L, *R)
    if kinds == (Segment, Point):
        return G.pt_seg_d2(*R, *L)
    if kinds == (Point, Box):
        return G.pt_box_d2(*L, *R)
    if kinds == (Box, Point):
        return G.pt_box_d2(*R, *L)
    if kinds == (Segment, Segment):
        return G.seg_seg_d2(L, R)
    if kinds == (Segment, Box):
        return G.seg_box_d2(L, R)
    if kinds == (Box, Segment):
        return G.seg_box_d2(R, L)
    if kinds == (Box, Box):
        return G.box_box_d2(L, R)
    raise TypeError(f"no distance for {kinds}")


# ----------------------------------------------------------------- helpers
def default_cell(dist: float, least: float = 250.0) -> float:
    """Cell side: twice the search distance, at least ``least`` units."""
    return max(2.0 * float(dist), least)


#: Smallest cells of joins whose points stand in one cell: a point meets what lies in its cell, so wide ones cost pairs.
LEAST_CELL = 64.0


def _with_cells(df: DataFrame, g, size: float, margin: float | str, cut: bool = True) -> DataFrame:
    """Explode the cells of ``g`` (expanded by margin) into ``_cx, _cy``."""
    if isinstance(g, Point) and margin == 0:
        return (df.withColumn("_cx", F.expr(grid.cell_of(f"`{g.x}`", size)))
                  .withColumn("_cy", F.expr(grid.cell_of(f"`{g.y}`", size))))
    return (df.withColumn("_c", F.explode(F.expr(_cover(g, size, margin, cut))))
              .withColumn("_cx", F.col("_c.cx")).withColumn("_cy", F.col("_c.cy")).drop("_c"))


def _cover(g, size: float, margin: float | str, cut: bool) -> str:
    """Cells of ``g`` expanded by margin; ``cut``: a segment piece by piece, not by its bounding box."""
    if isinstance(g, Segment) and cut:
        return grid.segment_cover(*(f"`{c}`" for c in g.cols()), size, margin)
    return grid.box_cover(*_own_bbox(g), size, margin)


def _own_bbox(g) -> tuple:
    return tuple(c.replace("_.", "") for c in bbox_of(g, "_"))


def _on_levels(df: DataFrame, g, sizes: list, margin: float | str, role: str, split: bool, outer: bool) -> DataFrame:
    """Explode the places of ``g`` on the grids of several levels into ``_place, _cx, _cy`` and, for the lowest cell
    of its cover there, ``_x0, _y0``; ``_n`` is how many places a row has.

    Two shapes meet once, on the level of the larger one.  Key ``2 * level`` holds left rows of that level and
    right rows up to it, ``2 * level + 1`` right rows of that level and smaller left ones; so two small shapes
    never meet under a large cell.  ``split``: the right side is on levels by its size, too; if not (points, or
    segments that are cut) all of it counts as lowest.
    """
    m = f"({margin})" if isinstance(margin, str) else repr(float(margin))
    xmin, ymin, xmax, ymax = _own_bbox(g)
    by_size = role == "left" or split
    df = df.withColumn("_level", F.expr(grid.level_of(f"greatest(({xmax}) - ({xmin}), ({ymax}) - ({ymin})) + 2 * {m}", sizes) if by_size else "0"))

    def place(k: int, size: float) -> str:
        low = f"'x0', {grid.cell_of(f'({xmin}) - {m}', size)}, 'y0', {grid.cell_of(f'({ymin}) - {m}', size)}"
        return f"transform({_cover(g, size, margin, cut=not split)}, k_ -> named_struct('k', {k}, 'cx', k_.cx, 'cy', k_.cy, {low}))"

    places = []
    for i, size in enumerate(sizes):
        own, lower = f"_level = {i}", f"_level < {i}"
        if role == "left":
            places.append((own, place(2 * i, size)))
            if split and i:
                places.append((lower, place(2 * i + 1, size)))
        else:
            places.append((f"_level <= {i}", place(2 * i, size)))
            if split and i:
                places.append((own, place(2 * i + 1, size)))
    none = "cast(array() AS array<struct<k:int,cx:bigint,cy:bigint,x0:bigint,y0:bigint>>)"
    cells = "concat(" + ", ".join(f"CASE WHEN {when} THEN {what} ELSE {none} END" for when, what in places) + ")"
    df = df.withColumn("_cells", F.expr(cells)).withColumn("_n", F.greatest(F.size("_cells"), F.lit(1)))
    df = df.withColumn("_c", F.explode_outer("_cells") if outer else F.explode("_cells"))
    return df.select("*", F.col("_c.k").alias("_place"), F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"),
                     F.col("_c.x0").alias("_x0"), F.col("_c.y0").alias("_y0")).drop("_c", "_cells", "_level")


def _rename_right(left: DataFrame, right: DataFrame, prefix: str) -> tuple[DataFrame, dict]:
    clash = set(left.columns) & set(right.columns)
    mapping = {c: (prefix + c if c in clash else c) for c in right.columns}
    return right, mapping


# ------------------------------------------------------------- the operator
def _pairs(l: DataFrame, r: DataFrame, cond, how: str, left: DataFrame, right: DataFrame, right_prefix: str,
           dist_sql: str | None, distance_col: str | None) -> DataFrame:
    if how in ("left_semi", "left_anti"):
        return l.join(r, cond, how).select([F.col(f"l.`{c}`") for c in left.columns])
    if how != "inner":
        raise ValueError(how)
    _, mapping = _rename_right(left, right, right_prefix)
    sel = [F.col(f"l.`{c}`") for c in left.columns]
    sel += [F.col(f"r.`{c}`").alias(mapping[c]) for c in right.columns]
    if distance_col:
        sel.append(F.sqrt(F.expr(dist_sql)).alias(distance_col))
    return l.join(r, cond, "inner").select(sel)


@dataclass(frozen=True)
class Ground:
    """A search radius of ``metres`` on the ground, at most ``planar`` units.

    Each right row gets the planar distance that bounds the metres at its own latitude: Mercator stretches by
    ``cosh(y / R)``, the spheroid by less than 0.7 %; the row's ordinates ``ys`` are moved outwards by more than
    the radius before.  So no latitude is special and nothing has to be refused.
    """
    metres: float
    ys: tuple = ("y1", "y2")
    planar: float | None = None
    slack: float = 0.0

    def sql(self) -> str:
        y = "greatest(" + ", ".join(f"abs(`{c}`)" for c in self.ys) + ")" if len(self.ys) > 1 else f"abs(`{self.ys[0]}`)"
        m = float(self.metres)
        r = f"({m * 1.007} * cosh(({y} + {20 * m}) / {crs.R_MERCATOR}) * {1 + self.slack} + {100 * self.slack})"
        return r if self.planar is None else f"least({r}, {float(self.planar)})"

    def typical(self) -> float:
        """The radius at middle latitudes, for the cell size."""
        return min(1.5 * self.metres, self.planar or math.inf)


def dwithin_join(left: DataFrame, right: DataFrame, dist: float | Ground, *,
                 left_geom=Point(), right_geom=Segment(), how: str = "inner",
                 cell: float | None = None, op: str = "<=", residual: str | None = None,
                 left_key: str | None = None, levels: int | None = None,
                 distance_col: str | None = None, right_prefix: str = "r_") -> DataFrame:
    """Pairs (left, right) whose planar distance is ``<= dist`` (``op='<'``: strict).

    ``how``: ``inner`` (all pairs; right columns that clash are prefixed),
    ``left_semi`` (left rows with a partner), ``left_anti`` (left rows without
    one).  ``residual`` is extra SQL over ``l.`` / ``r.`` columns that the
    partner must also satisfy (attribute OR distance conditions, geodesic
    refinement...).

    Points on the left stand in one cell, and the right side is dealt to the cells in reach.  Other
    shapes stand on grids of several ``levels`` (three unless the caller says otherwise), each on the one of its own
    size (:func:`_on_levels`), so houses and whole regions take one join and neither costs cells by its area.
    With ``levels`` points take it, too: for right sides of mixed sizes.  Semi and anti joins on levels
    bring the places of a row together by ``left_key`` (unique, not null) afterwards.
    """
    least = LEAST_CELL if isinstance(left_geom, Point) and levels is None and isinstance(right_geom, (Point, Segment)) else 250.0
    size = float(cell or default_cell(dist.typical() if isinstance(dist, Ground) else dist, least))
    if isinstance(dist, Ground):  # the radius is a column of the right side; the residual decides on the ground
        plain, reach = right.columns, "_reach"
        right = right.withColumn(reach, F.expr(dist.sql()))
        pred = within_sql(left_geom, right_geom, f"r.{reach}", "<=")
        if how == "inner":
            out = dwithin_cells(left, right, reach, size, pred, residual, left_geom, right_geom, how, left_key, levels,
                                dist2_sql(left_geom, right_geom) if distance_col else None, distance_col, right_prefix)
            return out.drop(reach if reach not in left.columns else right_prefix + reach)
        return dwithin_cells(left, right, reach, size, pred, residual, left_geom, right_geom, how, left_key, levels, None, None, right_prefix)
    pred = within_sql(left_geom, right_geom, dist, op)
    dsql = dist2_sql(left_geom, right_geom) if distance_col else None
    return dwithin_cells(left, right, float(dist), size, pred, residual, left_geom, right_geom, how, left_key, levels, dsql,
                         distance_col, right_prefix)


def dwithin_cells(left: DataFrame, right: DataFrame, dist: float | str, size: float, pred: str, residual, left_geom, right_geom,
                  how: str, left_key, levels, dsql, distance_col, right_prefix: str) -> DataFrame:
    """The cell join of :func:`dwithin_join` for a radius that is a number or a column of the right side."""
    if residual:
        pred = f"({pred}) AND ({residual})"
    if isinstance(left_geom, Point) and levels is None:
        same_cell = (F.col("l._cx") == F.col("r._cx")) & (F.col("l._cy") == F.col("r._cy"))
        l = _with_cells(left, left_geom, size, 0.0).alias("l")
        r = _with_cells(right, right_geom, size, dist).alias("r")
        return _pairs(l, r, same_cell & F.expr(pred), how, left, right, right_prefix, dsql, distance_col)
    return _level_join(left, right, dist, grid.level_sizes(size, levels or 3), pred, left_geom, right_geom, how, left_key, dsql,
                       distance_col, right_prefix)


def _level_join(left: DataFrame, right: DataFrame, margin: float | str, sizes: list, pred: str, left_geom, right_geom, how: str,
                left_key: str | None, dsql, distance_col, right_prefix: str, boxes: bool = False) -> DataFrame:
    """Join of shapes of any size on the grids of :func:`_on_levels`; the right side is expanded by ``margin``.
    ``boxes``: the bounding box of a segment counts, so it is never cut."""
    if how in ("left_semi", "left_anti") and not left_key:
        raise ValueError("semi/anti join on levels needs left_key")
    # each pair is wanted once in an inner join: then segments take the cells of their box, of which there are four at most
    split = boxes or isinstance(right_geom, (Box, Polygon)) or (how == "inner" and isinstance(right_geom, Segment) and not isinstance(left_geom, Point))
    if isinstance(left_geom, Point) and not split:
        sizes = sizes[:1]
    lc = _on_levels(left, left_geom, sizes, 0.0, "left", split, outer=how != "inner").alias("l")
    rc = _on_levels(right, right_geom, sizes, margin, "right", split, outer=False).alias("r")
    same_cell = (F.col("l._place") == F.col("r._place")) & (F.col("l._cx") == F.col("r._cx")) & (F.col("l._cy") == F.col("r._cy"))
    if how == "inner":  # a pair counts in the lowest cell that both covers share
        lowest = (F.col("l._cx") == F.greatest("l._x0", "r._x0")) & (F.col("l._cy") == F.greatest("l._y0", "r._y0"))
        cond = same_cell & F.expr(pred) if isinstance(left_geom, Point) else same_cell & lowest & F.expr(pred)
        return _pairs(lc, rc, cond, how, left, right, right_prefix, dsql, distance_col)
    # a row of several places has a partner if one of them has, and none if all of them have none
    got = lc.join(rc, same_cell & F.expr(pred), how)
    if how == "left_semi":
        got = got.withColumn("_n", F.lit(1))
    own = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    rows = got.groupBy(F.col(f"`{left_key}`").alias("_key")).agg(F.first(own).alias("_row"), F.count("*").alias("_c"), F.max("_n").alias("_n"))
    return rows.where("_c >= _n").select([F.col(f"_row.`{c}`").alias(c) for c in left.columns])


def _edges(rings: str) -> str:
    return (f"flatten(transform({rings}, er_ -> transform(filter(sequence(1, greatest(size(er_) - 1, 1)), "
            f"ei_ -> ei_ < size(er_)), ei_ -> named_struct('x1', er_[ei_-1].x, 'y1', er_[ei_-1].y, "
            f"'x2', er_[ei_].x, 'y2', er_[ei_].y))))")


def _ring_edges(rings: str) -> str:
    """Edges of all rings; ``s`` marks the first of each ring."""
    return (f"flatten(transform({rings}, er_ -> transform(filter(sequence(1, greatest(size(er_) - 1, 1)), "
            f"ei_ -> ei_ < size(er_)), ei_ -> named_struct('x1', cast(er_[ei_-1].x AS double), 'y1', cast(er_[ei_-1].y AS double), "
            f"'x2', cast(er_[ei_].x AS double), 'y2', cast(er_[ei_].y AS double), 's', ei_ = 1))))")


# ------------------------------------------------------- polygons cut by cells
#: Height in a cell, as a share of its side, at which its reference point lies.
LEVEL = 0.4271


def polygon_pieces(polygons: DataFrame, key: list, polygon=Polygon(), cell: float = 1000.0) -> DataFrame:
    """Polygons cut into the pieces that lie in single cells.

    One row for each polygon (``key``: its unique columns) and cell ``_cx, _cy``
    that it touches: ``_full`` (the cell lies inside as a whole), or the edges that
    meet the cell (``_edges``) and a point of the cell (``_xr, _yr``) of which
    ``_in`` says whether it is inside.  Nothing else of a ring is needed to decide
    about any point of the cell, so no row carries more than one cell's edges.
    ``_a`` holds the other columns, without the rings.

    Every edge is dealt to its cells and, at the height of a row's reference
    points, crosses that row in one cell at most.  The parity of a point is the
    number of crossings to its right: those of its own cell and a running sum over
    the polygon's cells of that row.  Cells between two touched ones are all inside
    or all outside, by the same sum.  The work is linear in edges and cells.
    """
    size = float(cell)
    attrs = [c for c in polygons.columns if c not in key and c != polygon.rings]
    other = F.struct(*[F.col(f"`{c}`") for c in attrs]) if attrs else F.struct(F.lit(True).alias("_"))
    edges = polygons.select(*key, other.alias("_a"), F.explode(F.expr(_ring_edges(f"`{polygon.rings}`"))).alias("_e"))
    cells = edges.select(*key, "_a", "_e", F.explode(F.expr(
        grid.segment_cover("_e.x1", "_e.y1", "_e.x2", "_e.y2", size, size * 1e-6))).alias("_c"))
    y = f"((_c.cy + {LEVEL}) * {size})"
    x = f"(_e.x1 + ({y} - _e.y1) * (_e.x2 - _e.x1) / nullif(_e.y2 - _e.y1, 0D))"
    crossing = f"CASE WHEN (_e.y1 > {y}) <> (_e.y2 > {y}) THEN CASE WHEN cast(floor({x} / {size}) AS bigint) = _c.cx THEN {x} END END"
    cells = cells.select(*key, "_a", "_e", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"), F.expr(crossing).alias("_x"))
    own = cells.groupBy(*key, "_cx", "_cy").agg(F.first("_a").alias("_a"), F.collect_list("_e").alias("_edges"),
                                                F.array_sort(F.collect_list("_x")).alias("_xs"))
    w = Window.partitionBy(*key, "_cy").orderBy(F.desc("_cx"))
    own = (own.withColumn("_right", F.coalesce(F.sum(F.size("_xs")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_next", F.lag("_cx").over(w)))
    # the reference point: the middle of the widest gap between crossings, so no edge is near it
    stops = f"concat(array(_cx * {size}), _xs, array((_cx + 1) * {size}))"
    own = own.withColumn("_xr", F.expr(
        f"element_at(transform(array({stops}), ps_ -> array_max(transform(sequence(1, size(ps_) - 1), "
        f"i_ -> named_struct('g', ps_[i_] - ps_[i_-1], 'm', (ps_[i_] + ps_[i_-1]) / 2))).m), 1)"))
    inside = "(_right + size(filter(_xs, x_ -> x_ > _xr))) % 2 = 1"
    between = ("CASE WHEN _next > _cx + 1 AND _right % 2 = 1 THEN transform(sequence(_cx + 1, _next - 1), "
               "c_ -> named_struct('cx', c_, 'full', true)) ELSE array() END")
    out = own.select(*key, "_a", "_cy", "_edges", "_xr", F.expr(inside).alias("_in"),
                     F.explode(F.expr(f"concat(array(named_struct('cx', _cx, 'full', false)), {between})")).alias("_i"))
    touched = ~F.col("_i.full")
    return out.select(*key, "_a", F.col("_i.cx").alias("_cx"), "_cy", F.col("_i.full").alias("_full"),
                      F.when(touched, F.col("_edges")).alias("_edges"), F.when(touched, F.col("_xr")).alias("_xr"),
                      F.expr(f"(_cy + {LEVEL}) * {size}").alias("_yr"), F.when(touched, F.col("_in")).alias("_in"))


def in_piece_sql(px: str, py: str, p: str = "r", boundary: bool = True) -> str:
    """A point of the piece's cell lies in the polygon: the parity of the reference point, changed by every edge
    between the two.  A vertex on the line between them counts to one side, so it never counts twice or not at all."""
    e = ("e_.x1", "e_.y1", "e_.x2", "e_.y2")
    xr, yr = f"{p}._xr", f"{p}._yr"
    on = (f"exists({p}._edges, e_ -> {G.cross(px, py, *e)} = 0 AND least(e_.x1, e_.x2) <= ({px}) AND ({px}) <= greatest(e_.x1, e_.x2) "
          f"AND least(e_.y1, e_.y2) <= ({py}) AND ({py}) <= greatest(e_.y1, e_.y2))")
    side = lambda vx, vy: f"({G.cross(vx, vy, xr, yr, px, py)} > 0)"
    meets = (f"({side('e_.x1', 'e_.y1')} <> {side('e_.x2', 'e_.y2')} AND "
             f"sign({G.cross(xr, yr, *e)}) * sign({G.cross(px, py, *e)}) < 0)")
    odd = f"((aggregate({p}._edges, CASE WHEN {p}._in THEN 1 ELSE 0 END, (n_, e_) -> n_ + CASE WHEN {meets} THEN 1 ELSE 0 END)) % 2 = 1)"
    return f"({p}._full OR {on} OR {odd})" if boundary else f"({p}._full OR (NOT {on} AND {odd}))"


def _cell_box(p: str, size: float) -> tuple:
    return (f"({p}._cx * {size})", f"({p}._cy * {size})", f"(({p}._cx + 1) * {size})", f"(({p}._cy + 1) * {size})")


def polygons_intersect_join(ldf: DataFrame, rdf: DataFrame, *, left_key: tuple[str, ...], right_key: tuple[str, ...],
                            left_geom=Polygon(), right_geom=Polygon(), cell: float = 1000.0, right_prefix: str = "r_") -> DataFrame:
    """Pairs of polygons (``left_key``, ``right_key``: their unique columns) that share a point, each pair once,
    with all columns but the rings.

    Pieces meet by cell, and a cell stops at the first thing found: both fill it, an edge runs through a
    cell that the other fills, two edges meet, or - for rings that lie in the other polygon without meeting
    an edge - the first vertex of a ring lies in the other's piece.  So a pair costs the edges that it has
    in common cells, not edges times edges.
    """
    size = float(cell)
    lk, rk = [f"_l{i}" for i in range(len(left_key))], [f"_r{i}" for i in range(len(right_key))]
    side = lambda df, g, key, names: polygon_pieces(df, list(key), g, cell).select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(key, names)], "_cx", "_cy", "_full", "_edges", "_xr", "_yr", "_in")
    l, r = side(ldf, left_geom, left_key, lk).alias("l"), side(rdf, right_geom, right_key, rk).alias("r")
    box = _cell_box("l", size)
    e, f = ("e_.x1", "e_.y1", "e_.x2", "e_.y2"), ("f_.x1", "f_.y1", "f_.x2", "f_.y2")
    through = lambda p: f"exists({p}._edges, e_ -> {G.seg_intersects_box(e, box)})"
    here = f"floor(v_.x / {size}) = l._cx AND floor(v_.y / {size}) = l._cy"
    starts = lambda p: f"transform(filter({p}._edges, e_ -> e_.s), e_ -> named_struct('x', e_.x1, 'y', e_.y1))"
    nested = lambda a, b: f"exists({starts(a)}, v_ -> {here} AND {in_piece_sql('v_.x', 'v_.y', b)})"
    meet = (f"CASE WHEN l._full AND r._full THEN true WHEN l._full THEN {through('r')} WHEN r._full THEN {through('l')} "
            f"ELSE exists(l._edges, e_ -> exists(r._edges, f_ -> {G.seg_intersects(e, f)})) OR {nested('l', 'r')} OR {nested('r', 'l')} END")
    cond = (F.col("l._cx") == F.col("r._cx")) & (F.col("l._cy") == F.col("r._cy")) & F.expr(meet)
    pairs = l.join(r, cond).select(*lk, *rk).distinct()
    _, mapping = _rename_right(ldf, rdf, right_prefix)
    left = ldf.drop(left_geom.rings)
    right = rdf.drop(right_geom.rings)
    right = right.select([F.col(f"`{c}`").alias(mapping[c]) for c in right.columns])
    out = pairs.join(left, [pairs[n] == left[k] for k, n in zip(left_key, lk)]).drop(*lk)
    return out.join(right, [out[n] == right[mapping[k]] for k, n in zip(right_key, rk)]).drop(*rk)


# ------------------------------------------------------------ geodesic tests
def geo_scales(y: str) -> tuple[str, str]:
    """Ground metres per Mercator unit (along x, along y) at ordinate y."""
    return crs.scale_e(y), crs.scale_n(y)


def with_geo_scales(df: DataFrame, y: str, sx: str = "_sx", sy: str = "_sy") -> DataFrame:
    """Add the ground scale factors at ordinate ``y`` as columns, so join
    residuals refer to two numbers instead of repeating the formula."""
    return df.withColumn(sx, F.expr(crs.scale_e(y))).withColumn(sy, F.expr(crs.scale_n(y)))


L_SCALES = ("l._sx", "l._sy")


def geo_pt_seg_within(px: str, py: str, seg: tuple, metres, op: str = "<=",
                      scales: tuple[str, str] | None = None) -> str:
    """Geodesic ``distance(point, segment) <op> metres`` in the local metric
    of the point (Mercator offsets scaled by the ground scale at its
    latitude)."""
    sx, sy = scales or geo_scales(py)
    x1, y1, x2, y2 = seg
    return G.pt_seg_within("0", "0", f"(({x1}) - ({px})) * {sx}", f"(({y1}) - ({py})) * {sy}",
                           f"(({x2}) - ({px})) * {sx}", f"(({y2}) - ({py})) * {sy}", str(metres), op)


def geo_pt_pt_within(px: str, py: str, qx: str, qy: str, metres, op: str = "<=",
                     scales: tuple[str, str] | None = None) -> str:
    sx, sy = scales or geo_scales(py)
    return G.pt_pt_within("0", "0", f"(({qx}) - ({px})) * {sx}", f"(({qy}) - ({py})) * {sy}", str(metres), op)


def geo_pt_seg_d(px: str, py: str, seg: tuple, scales: tuple[str, str] | None = None) -> str:
    """Geodesic point-segment distance in metres (local metric at the point)."""
    sx, sy = scales or geo_scales(py)
    x1, y1, x2, y2 = seg
    return "sqrt(" + G.pt_seg_d2("0", "0", f"(({x1}) - ({px})) * {sx}", f"(({y1}) - ({py})) * {sy}",
                                 f"(({x2}) - ({px})) * {sx}", f"(({y2}) - ({py})) * {sy}") + ")"


def geo_pt_box_d2(px: str, py: str, box: tuple, scales: tuple[str, str] | None = None) -> str:
    """Squared ground distance (m^2) point-box in the local metric of the point."""
    sx, sy = scales or geo_scales(py)
    xmin, ymin, xmax, ymax = box
    return G.pt_box_d2("0", "0", f"(({xmin}) - ({px})) * {sx}", f"(({ymin}) - ({py})) * {sy}",
                       f"(({xmax}) - ({px})) * {sx}", f"(({ymax}) - ({py})) * {sy}")


def geo_pt_rings_d(px: str, py: str, rings: str, scales: tuple[str, str] | None = None) -> str:
    """Ground distance (m) of a point to the boundary of a polygon, in the local metric of the point."""
    d = geo_pt_seg_d(px, py, ("e.x1", "e.y1", "e.x2", "e.y2"), scales)
    return f"array_min(transform({_edges(rings)}, e -> {d}))"


def geo_len_to_closest(px: str, py: str, seg: tuple, scales: tuple[str, str] | None = None) -> str:
    """Ground length (m) of the planar shortest line from a point to a
    segment (PostGIS ``st_length(st_shortestline(...)::geography)``)."""
    sx, sy = scales or geo_scales(py)
    x1, y1, x2, y2 = seg
    t = G.closest_t(px, py, x1, y1, x2, y2)
    cx = f"(({x1}) + (({x2}) - ({x1})) * {t})"
    cy = f"(({y1}) + (({y2}) - ({y1})) * {t})"
    return f"sqrt(power(({cx} - ({px})) * {sx}, 2) + power(({cy} - ({py})) * {sy}, 2))"


def contains_join(points: DataFrame, polygons: DataFrame, polygon_key: tuple[str, ...], *, point=Point(), polygon=Polygon(),
                  boundary: bool = True, how: str = "inner", cell: float = 1000.0, right_prefix: str = "r_") -> DataFrame:
    """Point-in-polygon join (A1 ``boundary=True``: covers/intersects; A2 ``False``: strict contains).

    Points meet the pieces of the polygons (:func:`polygon_pieces`) by cell; each point lives in one cell, so
    no pair repeats.  The result has the columns of both sides but the rings; join them back by
    ``polygon_key`` (the polygons' unique columns) where a check needs the shape.
    """
    key = list(polygon_key)
    l = _with_cells(points, point, float(cell), 0.0).alias("l")
    r = polygon_pieces(polygons, key, polygon, cell).alias("r")
    px, py = _q("l", point.cols())
    cond = (F.col("l._cx") == F.col("r._cx")) & (F.col("l._cy") == F.col("r._cy")) & F.expr(in_piece_sql(px, py, "r", boundary))
    if how in ("left_semi", "left_anti"):
        return l.join(r, cond, how).select([F.col(f"l.`{c}`") for c in points.columns])
    _, mapping = _rename_right(points, polygons, right_prefix)
    sel = [F.col(f"l.`{c}`") for c in points.columns]
    sel += [(F.col(f"r.`{c}`") if c in key else F.col(f"r._a.`{c}`")).alias(mapping[c]) for c in polygons.columns if c != polygon.rings]
    return l.join(r, cond, how).select(sel)


# ------------------------------------------------------------------- nearest
def nearest_join(points: DataFrame, lines: DataFrame, *, key: tuple[str, ...], by: tuple[tuple[str, str], ...] = (), start: float,
                 distance: str | None = None, scale: str = "1D", left_geom=Point(), right_geom=Segment(), distance_col: str = "d",
                 factor: float = 2.0) -> DataFrame:
    """A4 without a radius: each point with the distance to its nearest line, whatever that is.

    ``key``: columns that identify a point; ``by``: (point column, line column) that must be equal.
    ``distance``: SQL of the distance over the columns of both sides (planar if none), at least ``scale`` (SQL over the
    point's columns) times the planar one.  Points without a line of their group, or without a place, have no row.

    Rings that grow: points look within ``start`` planar units, by cells of that size; what was found nearer than
    the ring is proven, and only the other points go on with a ring ``factor`` times as wide.  So a point
    meets the lines about as far away as its nearest one, not all lines of its group.  Rounds are as many as
    powers of ``factor`` up to the largest distance; each is checkpointed.
    """
    placed = lambda df, g: df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in g.cols()))
    lines = placed(lines, right_geom)
    rest = placed(points, left_geom)
    if by:
        groups = lines.select(*[F.col(r).alias(f"_b{i}") for i, (_, r) in enumerate(by)]).distinct()
        rest = rest.join(groups, [F.col(l) == F.col(f"_b{i}") for i, (l, _) in enumerate(by)], "left_semi")
    ensure_checkpoint_dir(points.sparkSession)
    rest, lines = rest.checkpoint(), lines.checkpoint()
    d = F.expr(distance) if distance else F.col("_planar")
    residual = " AND ".join(f"l.`{l}` = r.`{r}`" for l, r in by) or None
    done, radius = None, float(start)
    while not rest.isEmpty():
        pairs = dwithin_join(rest, lines, radius, left_geom=left_geom, right_geom=right_geom, residual=residual, distance_col="_planar")
        best = pairs.groupBy(*key).agg(F.min(d).alias(distance_col), F.first(F.expr(scale)).alias("_scale"))
        best = best.where(F.col(distance_col) <= radius * F.col("_scale")).drop("_scale").checkpoint()
        found = rest.join(best, list(key))
        done = found if done is None else done.unionByName(found)
        rest = rest.join(best, list(key), "left_anti").checkpoint()
        if radius > 1e9:
            raise ValueError("points or lines beyond any distance")
        radius *= factor
    return done if done is not None else rest.withColumn(distance_col, F.lit(None).cast("double"))


def nearest_within(points: DataFrame, lines: DataFrame, dist: float, *, key: tuple[str, ...], pick: tuple[str, ...],
                   left_geom=Point(), right_geom=Segment()) -> DataFrame:
    """The nearest line within ``dist`` of each point: ``key`` and the place of the point, ``d2`` (squared distance) and the
    columns ``pick`` of the line, whose order decides between lines at the same distance.

    Points look within an eighth of ``dist`` first, and only those that found nothing look farther, so a point meets few
    lines where there are many.  The smallest distance comes by a hash aggregate that keeps one number a point, then the lines
    at it: the pairs are neither sorted nor shuffled.
    """
    ensure_checkpoint_dir(points.sparkSession)
    cols = list(dict.fromkeys([*key, *left_geom.cols()]))
    rest = points.select(*cols).distinct().checkpoint()
    lines = lines.select(*dict.fromkeys([*pick, *right_geom.cols()])).checkpoint()
    met = {"left_geom": left_geom, "right_geom": right_geom}
    most = int(dist) if dist == int(dist) else dist
    radii = sorted({min(most, math.ceil(dist / part)) for part in (8, 1)})
    done = None
    for radius in radii:
        d2 = G.pt_seg_d2(*left_geom.cols(), *right_geom.cols())
        least = dwithin_join(rest, lines, radius, **met).groupBy(*cols).agg(F.min(F.expr(d2)).alias("_least"))
        at = dwithin_join(least, lines, radius, residual=f"{dist2_sql(left_geom, right_geom)} = l._least", **met)
        best = at.groupBy(*cols).agg(F.first("_least").alias("d2"), F.min(F.struct(*pick)).alias("_line"))
        if radius != radii[-1]:
            best = best.checkpoint()
            rest = rest.join(best, cols, "left_anti").checkpoint()
        done = best if done is None else done.unionByName(best)
    return done.select(*cols, "d2", *[f"_line.{c}" for c in pick])


def bbox_join(left: DataFrame, right: DataFrame, margin: float = 0.0, *, left_geom=Point(),
              right_geom=Box(), how: str = "inner", cell: float | None = None,
              residual: str | None = None, left_key: str | None = None,
              right_prefix: str = "r_") -> DataFrame:
    """Bounding boxes meet after expanding the left one by ``margin``
    (``a && st_expand(b, m)``), as a cell join; on levels where a row may have several places
    (inner joins, and all with ``left_key``)."""
    size = float(cell or default_cell(max(margin, 1.0)))
    pred = G.box_overlap(bbox_of(left_geom, "l"), bbox_of(right_geom, "r"), str(margin))
    if residual:
        pred = f"({pred}) AND ({residual})"
    if how == "inner" or left_key:
        return _level_join(left, right, float(margin), grid.level_sizes(size, 3), pred, left_geom, right_geom, how, left_key, None, None,
                           right_prefix, boxes=True)
    if not isinstance(left_geom, Point):
        raise ValueError("semi/anti join of non-point geometries needs left_key")
    l = _with_cells(left, left_geom, size, 0.0).alias("l")
    r = _with_cells(right, right_geom, size, float(margin), cut=False).alias("r")
    cond = (F.col("l._cx") == F.col("r._cx")) & (F.col("l._cy") == F.col("r._cy")) & F.expr(pred)
    return _pairs(l, r, cond, how, left, right, right_prefix, None, None)


def bbox_key_pairs(points: DataFrame, segments: DataFrame, point_key: str, segment_key: str, margin: float, *,
                   point=Point(), segment=Segment(), cell: float | None = None) -> DataFrame:
    """Distinct ``(point_key, segment_key)`` of which a point, expanded by ``margin``, meets the bounding box of a segment.

    The segments of a key stand in a cell as one row, all on the level of the key's largest one, so a point meets a
    key once and its pairs need no ``distinct``.  Only those of point keys with several points do; they are few as a rule.
    """
    k, g = F.col(f"`{point_key}`"), F.col(f"`{segment_key}`")
    box = ("xmin", "ymin", "xmax", "ymax")
    sizes = grid.level_sizes(float(cell or default_cell(margin, LEAST_CELL)), 4)
    s = segments.select(g.alias("_g"), *[F.expr(e).alias(c) for c, e in zip(box, _own_bbox(segment))])
    level = grid.level_of("greatest(xmax - xmin, ymax - ymin)", sizes)  # a box and its margin cover few cells of its level
    s = s.withColumn("_level", F.max(F.expr(level)).over(Window.partitionBy("_g")))
    covers = " ".join(f"WHEN {i} THEN {grid.box_cover(*box, size, float(margin))}" for i, size in enumerate(sizes))
    s = s.select("*", F.explode(F.expr(f"CASE _level {covers} END")).alias("_c"))
    s = s.groupBy("_level", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"), "_g").agg(
        *[(F.min if c in ("xmin", "ymin") else F.max)(c).alias(c) for c in box], F.collect_set(F.struct(*box)).alias("_boxes"))
    at = ("l._x", "l._y", "l._x", "l._y")
    meet = lambda b: G.box_overlap(at, tuple(f"{b}.{c}" for c in box), str(margin))
    pred = F.expr(f"{meet('r')} AND (size(r._boxes) = 1 OR exists(r._boxes, b_ -> {meet('b_')}))")

    def pairs(p: DataFrame) -> DataFrame:
        cells = [f"named_struct('k', {i}, 'cx', {grid.cell_of('_x', size)}, 'cy', {grid.cell_of('_y', size)})" for i, size in enumerate(sizes)]
        l = p.select("*", F.explode(F.expr(f"array({', '.join(cells)})")).alias("_c"))
        l = l.select("_k", "_x", "_y", F.col("_c.k").alias("_level"), F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy")).alias("l")
        same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("_level", "_cx", "_cy")]
        return l.join(s.alias("r"), same[0] & same[1] & same[2] & pred).select(F.col("l._k").alias(point_key), F.col("r._g").alias(segment_key))

    p = points.select(k.alias("_k"), *[F.col(f"`{c}`").alias(n) for c, n in zip(point.cols(), ("_x", "_y"))]).where("_x IS NOT NULL AND _y IS NOT NULL")
    ends = p.groupBy("_k").agg(F.min(F.struct("_x", "_y")).alias("_a"), F.max(F.struct("_x", "_y")).alias("_b"))
    one = ends.where("_a = _b").select("_k", "_a._x", "_a._y")
    several = ends.where("_a <> _b").select(F.col("_k").alias("_s"))
    rest = p.join(several, F.col("_k").eqNullSafe(F.col("_s")), "left_semi").distinct()
    return pairs(one).unionAll(pairs(rest).distinct())
