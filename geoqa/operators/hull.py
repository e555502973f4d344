"""Convex hulls of grouped points (A10) and their diameter.

Two phases, like a map-side combine:

1. ``mapInPandas`` over the input partitions: every task reduces each group
   it sees to the hull of its share of the points (a hull of a subset keeps
   every vertex of the final hull that lies in it).
2. Only those partial hull vertices are shuffled by group; a second
   ``mapInPandas`` after ``repartition`` merges them.

hull(A u B) = hull(hull(A) u hull(B)), so the result is exact, and a group
holding a third of all rows never reaches one task whole: phase 2 sees at
most (number of input partitions) x (hull size) points per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoqa.session import ship_package


def monotone_chain(pts: np.ndarray) -> np.ndarray:
    """Counter-clockwise hull vertices (no repeated first point, collinear
    points dropped) of an (n, 2) array; 1 or 2 points for degenerate input."""
    pts = np.unique(pts, axis=0)  # sorted by x, then y
    if len(pts) <= 2:
        return pts

    def half(seq):
        out = []
        for p in seq:
            while len(out) >= 2:
                (ax, ay), (bx, by) = out[-2], out[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) <= 0:
                    out.pop()
                else:
                    break
            out.append((p[0], p[1]))
        return out

    lower = half(pts)
    upper = half(pts[::-1])
    return np.array(lower[:-1] + upper[:-1], dtype=float)


SMALL = 8  # groups up to this many distinct points take the vectorised path


def small_hull_mask(P: np.ndarray, V: np.ndarray) -> np.ndarray:
    """Hull-vertex mask for many small point sets at once.

    P: (G, K, 2) points, V: (G, K) validity.  Point p is a vertex when some
    other point q has every valid point r strictly left of p->q or on the
    ray from p through q (the same exact test as monotone chain with
    collinear points dropped); a set of one distinct point is its own hull.
    """
    px, py = P[:, :, None, None, 0], P[:, :, None, None, 1]
    qx, qy = P[:, None, :, None, 0], P[:, None, :, None, 1]
    rx, ry = P[:, None, None, :, 0], P[:, None, None, :, 1]
    cross = (qx - px) * (ry - py) - (qy - py) * (rx - px)
    dot = (rx - px) * (qx - px) + (ry - py) * (qy - py)
    ok_r = (cross > 0) | ((cross == 0) & (dot >= 0)) | ~V[:, None, None, :]
    distinct = (qx[..., 0] != px[..., 0]) | (qy[..., 0] != py[..., 0])
    cond_q = V[:, None, :] & distinct & ok_r.all(axis=3)
    single = V.sum(axis=1) == 1
    return V & (cond_q.any(axis=2) | single[:, None])


def _reduce_groups(gcols: list, x: str, y: str):
    """mapInPandas body: hull per group over all batches of the task."""

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        """Hull of every group of one frame: one sort, then numpy slices."""
        if pdf.empty:
            return pdf[[*gcols, x, y]]
        codes, uniq = pd.MultiIndex.from_frame(pdf[gcols]).factorize()
        xs, ys = pdf[x].to_numpy(dtype=float), pdf[y].to_numpy(dtype=float)
        order = np.lexsort((ys, xs, codes))
        codes, xs, ys = codes[order], xs[order], ys[order]
        # drop repeated points (sorted, so repeats are adjacent)
        new = np.r_[True, (codes[1:] != codes[:-1]) | (xs[1:] != xs[:-1]) | (ys[1:] != ys[:-1])]
        codes, xs, ys = codes[new], xs[new], ys[new]
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        ends = np.r_[starts[1:], len(codes)]
        sizes = ends - starts
        keep_code, keep_x, keep_y = [], [], []
        small = np.flatnonzero(sizes <= SMALL)
        for chunk in np.array_split(small, max(1, len(small) // 4096)):
            if len(chunk) == 0:
                continue
            idx = starts[chunk][:, None] + np.arange(SMALL)[None, :]
            V = np.arange(SMALL)[None, :] < sizes[chunk][:, None]
            idx = np.where(V, idx, starts[chunk][:, None])
            P = np.stack([xs[idx], ys[idx]], axis=2)
            m = small_hull_mask(P, V)
            keep_code.append(codes[idx][m])
            keep_x.append(P[..., 0][m])
            keep_y.append(P[..., 1][m])
        for gi in np.flatnonzero(sizes > SMALL):
            s, e = starts[gi], ends[gi]
            h = monotone_chain(np.column_stack([xs[s:e], ys[s:e]]))
            keep_code.append(np.full(len(h), codes[s]))
            keep_x.append(h[:, 0])
            keep_y.append(h[:, 1])
        kc = np.concatenate(keep_code)
        out = pd.DataFrame({x: np.concatenate(keep_x), y: np.concatenate(keep_y)})
        keys = uniq[kc]
        for i, g in enumerate(gcols):
            out.insert(i, g, keys.get_level_values(i))
        return out.drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # reduce each batch as it comes (memory: partial hulls only), then once more
        partial = [reduce(pdf) for pdf in batches]
        if partial:
            yield reduce(pd.concat(partial, ignore_index=True))

    return run


def convex_hull(points: DataFrame, group_by: tuple[str, ...], x: str = "x", y: str = "y",
                partitions: int | None = None) -> DataFrame:
    """One row per group: ``hull`` (closed ring ``array<struct<x,y>>``, counter-
    clockwise) and ``nverts`` (number of distinct hull vertices)."""
    gcols = list(group_by)
    pts = points.select(*gcols, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y))
    schema = T.StructType([pts.schema[g] for g in gcols] + [T.StructField(x, T.DoubleType()),
                                                          T.StructField(y, T.DoubleType())])
    ship_package(points.sparkSession)  # the pandas function lives in this package
    partial = pts.mapInPandas(_reduce_groups(gcols, x, y), schema)
    merged = (partial.repartition(partitions, *gcols) if partitions else partial.repartition(*gcols))
    verts = merged.mapInPandas(_reduce_groups(gcols, x, y), schema)
    # restore the counter-clockwise order from the lowest (x, y) vertex: angle around the centroid
    w = verts.groupBy(*gcols).agg(F.collect_list(F.struct(x, y)).alias("_v"))
    ring = F.expr(f"""
      transform(array_sort(transform(_v, p -> named_struct(
          'a', atan2(p.{y} - aggregate(_v, 0D, (s, q) -> s + q.{y}) / size(_v),
                     p.{x} - aggregate(_v, 0D, (s, q) -> s + q.{x}) / size(_v)),
          'x', p.{x}, 'y', p.{y}))), p -> named_struct('x', p.x, 'y', p.y))""")
    out = w.select(*gcols, ring.alias("_r"), F.size("_v").alias("nverts"))
    return out.select(*gcols, F.concat("_r", F.slice("_r", 1, 1)).alias("hull"), "nverts")


def calipers(hull: str, length: str | None = None) -> str:
    """SQL: the largest squared distance between vertices of a closed convex ring, as a walk of rotating calipers.

    One end walks along the edges, the other one goes on while it gets further from the edge; at most three
    times round, so the cost is linear.  With ``length`` (SQL over vertices ``p_`` and ``q_``), the largest length
    of the pairs at that distance instead.
    """
    d2 = lambda a, b: f"(({a}.x - {b}.x) * ({a}.x - {b}.x) + ({a}.y - {b}.y) * ({a}.y - {b}.y))"
    area = lambda c: f"((s_.b.x - s_.a.x) * ({c}.y - s_.a.y) - (s_.b.y - s_.a.y) * ({c}.x - s_.a.x))"
    measure = (lambda a, b: "0D") if length is None else (lambda a, b: f"element_at(transform(array(named_struct('p_', {a}, 'q_', {b})), z_ -> {length.replace('p_.', 'z_.p_.').replace('q_.', 'z_.q_.')}), 1)")
    # a, b: the edge; c, e: the far vertex and the next one; pairs are compared by (distance, length)
    pair = lambda a, b: f"named_struct('d', cast({d2(a, b)} AS double), 'l', cast({measure(a, b)} AS double))"
    state = lambda i, j, best: (f"named_struct('i', {i}, 'j', {j}, 'a', h_[({i}) % n_], 'b', h_[({i} + 1) % n_], "  # noqa: E731
                                f"'c', h_[({j}) % n_], 'e', h_[({j} + 1) % n_], 'best', {best})")
    best = f"greatest(s_.best, {pair('s_.a', 's_.c')}, {pair('s_.b', 's_.c')}, {pair('s_.a', 's_.e')}, {pair('s_.b', 's_.e')})"
    step = (f"CASE WHEN s_.i >= n_ THEN s_ WHEN {area('s_.e')} > {area('s_.c')} THEN {state('s_.i', 's_.j + 1', best)} "
            f"ELSE {state('s_.i + 1', 's_.j', best)} END")
    none = "named_struct('d', 0D, 'l', 0D)"
    walk = f"aggregate(sequence(1, 3 * n_ + 1), {state('0', '1', none)}, (s_, k_) -> {step}).best"
    return (f"element_at(transform(array(named_struct('h', {hull}, 'n', greatest(size({hull}) - 1, 1))), t_ -> "
            f"{walk.replace('h_[', 't_.h[').replace('n_', 't_.n')}), 1).{'d' if length is None else 'l'}")


def hull_diameter(hulls: DataFrame, hull: str = "hull") -> F.Column:
    """Longest distance between two vertices of each hull (planar)."""
    return F.expr(f"sqrt({calipers(hull)})")
