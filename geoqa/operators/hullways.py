"""Ways against convex hulls: how many come near a hull, and how much of their length lies near and inside it.

A wide hull has thousands of ways near it, so a row for each pair of a hull and a way is too much.  Ways
stand in one cell each (by their middle, on the level of their size), hulls on every cell in reach.  What stands
in a cell is measured there, in numpy, flat over all its pairs:

1. ways of a cell are packed into tiles of ``TILE`` that lie together; a tile inside a hull counts by
   its sums, one out of reach not at all;
2. the ways of the other tiles, then the segments of the ways that cross a border, are told apart the same way;
3. only segments that may cross a border are clipped and, where that leaves it open, tested for the exact distance.

Every sum is a sum over ways, so a hull's parts from several cells add up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.operators import grid
from geoqa.session import ship_package

#: Side of the smallest cells, ways of a tile, shares in which the hulls of a cell are dealt out.
CELL, TILE, SHARES = 1024.0, 16, 4
#: Rows (a pair and an edge of its hull) that are worked on at once; hulls times tiles, or names, of a batch.
ROWS, BATCH = 1 << 17, 1 << 21
#: A clear overlap, as a share of a segment; shorter ones are left to the exact distance.
CLEAR = 1e-6

SUMS = ("sl", "slb", "sg", "sgh", "nsl", "nslb", "nsg", "nsgh")
COUNTS = ("n", "n_noname", "n_named")
NONE = np.iinfo(np.int64).min


def _runs(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and item of each row of the runs that begin at ``first`` and are ``count`` long."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) + np.repeat(first - (np.cumsum(count) - count), count)


def _chunks(weight: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of about ``limit`` in weight, of one item at least."""
    total, at = np.cumsum(weight), 0
    while at < len(weight):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, "right")))
        yield slice(at, end)
        at = end


def _numbers(a: pa.Array) -> np.ndarray:
    return np.asarray(a.to_numpy(zero_copy_only=False), dtype=float)


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t[name].combine_chunks()
    return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c


class _Hulls:
    """Closed counter-clockwise rings, edge by edge."""

    def __init__(self, rings: pa.Array, dist: float):
        one = rings.flatten()  # one ring a hull
        size = np.asarray(one.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        pts = one.flatten()
        x, y = _numbers(pts.field("x")), _numbers(pts.field("y"))
        first = np.cumsum(size) - size
        self.m = size - 1
        self.first = np.cumsum(self.m) - self.m
        _, at = _runs(first, self.m)
        self.x1, self.y1, self.x2, self.y2 = x[at], y[at], x[at + 1], y[at + 1]
        self.ux, self.uy = self.x2 - self.x1, self.y2 - self.y1
        self.length = np.sqrt(self.ux * self.ux + self.uy * self.uy)
        self.reach = (dist * (1 + 1e-9) + 1e-6) * self.length
        self.box = [f.reduceat(v, first) for f, v in ((np.minimum, x), (np.minimum, y), (np.maximum, x), (np.maximum, y))]
        self.solid = self.m >= 3
        self.dist = dist

    def in_reach(self, h: np.ndarray, box) -> np.ndarray:
        x0, y0, x1, y1 = (v[h] for v in self.box)
        d = self.dist * (1 + 1e-9) + 1e-6
        return (box[0] <= x1 + d) & (x0 - d <= box[2]) & (box[1] <= y1 + d) & (y0 - d <= box[3])

    def sides(self, h: np.ndarray, box) -> tuple[np.ndarray, np.ndarray]:
        """Which boxes lie inside their hull as a whole, and which are out of reach beyond one of its edges."""
        m = self.m[h]
        _, e = _runs(self.first[h], m)
        cx, cy, rx, ry = (np.repeat(v, m) for v in ((box[0] + box[2]) / 2, (box[1] + box[3]) / 2, (box[2] - box[0]) / 2, (box[3] - box[1]) / 2))
        ux, uy = self.ux[e], self.uy[e]
        mid = ux * (cy - self.y1[e]) - uy * (cx - self.x1[e])
        far = np.abs(ux) * ry + np.abs(uy) * rx
        at = np.cumsum(m) - m
        return (np.minimum.reduceat(mid - far, at) >= 0) & self.solid[h], np.minimum.reduceat(mid + far + self.reach[e], at) < 0

    def clip(self, h: np.ndarray, x1, y1, x2, y2) -> tuple[np.ndarray, np.ndarray]:
        """Shares of segments within ``dist`` of their hull, and inside it: a rectangle along every edge, a disc at every
        vertex and the hull itself; the whole is convex, so it is one interval from the smallest to the largest of them."""
        m = self.m[h]
        _, e = _runs(self.first[h], m)
        at = np.cumsum(m) - m
        ux, uy, ln, r = self.ux[e], self.uy[e], self.length[e], self.dist
        ax, ay = np.repeat(x1, m) - self.x1[e], np.repeat(y1, m) - self.y1[e]
        vx, vy = np.repeat(x2 - x1, m), np.repeat(y2 - y1, m)
        along, step = ax * ux + ay * uy, vx * ux + vy * uy
        off, rise = (ay * ux - ax * uy) / ln, (vy * ux - vx * uy) / ln
        s, t = -along / step, (ln * ln - along) / step
        lo, hi = np.maximum(np.minimum(s, t), 0), np.minimum(np.maximum(s, t), 1)
        level = step == 0
        lo, hi = np.where(level, 0, lo), np.where(level, np.where((along >= 0) & (along <= ln * ln), 1.0, -np.inf), hi)
        s, t = (r - off) / rise, -(r + off) / rise
        level = rise == 0
        lo = np.where(level, lo, np.maximum(lo, np.minimum(s, t)))
        hi = np.where(level, np.where(np.abs(off) <= r, hi, -np.inf), np.minimum(hi, np.maximum(s, t)))
        a, b, c = vx * vx + vy * vy, 2 * (vx * ax + vy * ay), ax * ax + ay * ay - r * r
        root = np.sqrt(b * b - 4 * a * c)  # not a number where the disc is missed
        dlo, dhi = np.maximum((-b - root) / (2 * a), 0), np.minimum((-b + root) / (2 * a), 1)
        still = a == 0
        dlo, dhi = np.where(still, 0, dlo), np.where(still, np.where(c <= 0, 1.0, -np.inf), dhi)
        some, disc = lo <= hi, dlo <= dhi
        blo = np.minimum.reduceat(np.minimum(np.where(some, lo, np.inf), np.where(disc, dlo, np.inf)), at)
        bhi = np.maximum.reduceat(np.maximum(np.where(some, hi, -np.inf), np.where(disc, dhi, -np.inf)), at)
        cut = -off / rise
        out = level & (off < 0)
        hlo = np.maximum(np.maximum.reduceat(np.where(rise > 0, cut, np.where(out, np.inf, 0.0)), at), 0)
        hhi = np.minimum(np.minimum.reduceat(np.where(rise < 0, cut, np.where(out, -np.inf, 1.0)), at), 1)
        within = self.solid[h] & (hlo <= hhi)
        blo, bhi = np.where(within, np.minimum(blo, hlo), blo), np.where(within, np.maximum(bhi, hhi), bhi)
        return np.where(blo < bhi, bhi - blo, 0.0), np.where(within, hhi - hlo, 0.0)

    def near(self, h: np.ndarray, x1, y1, x2, y2) -> np.ndarray:
        """Exact ``distance(hull, segment) <= dist``, without division."""
        m = self.m[h]
        _, e = _runs(self.first[h], m)
        px1, py1, px2, py2 = (np.repeat(v, m) for v in (x1, y1, x2, y2))
        edge, seg = (self.x1[e], self.y1[e], self.x2[e], self.y2[e]), (px1, py1, px2, py2)
        d2 = self.dist * self.dist
        cross = lambda px, py, a: (a[2] - a[0]) * (py - a[1]) - (a[3] - a[1]) * (px - a[0])

        def point(px, py, a):
            dot = (px - a[0]) * (a[2] - a[0]) + (py - a[1]) * (a[3] - a[1])
            l2 = (a[2] - a[0]) * (a[2] - a[0]) + (a[3] - a[1]) * (a[3] - a[1])
            sq = lambda u, v: u * u + v * v
            return np.where(dot <= 0, sq(px - a[0], py - a[1]) <= d2, np.where(dot >= l2, sq(px - a[2], py - a[3]) <= d2, cross(px, py, a) ** 2 <= d2 * l2))

        boxes = ((np.minimum(edge[0], edge[2]) <= np.maximum(px1, px2)) & (np.minimum(px1, px2) <= np.maximum(edge[0], edge[2]))
                 & (np.minimum(edge[1], edge[3]) <= np.maximum(py1, py2)) & (np.minimum(py1, py2) <= np.maximum(edge[1], edge[3])))
        side = cross(px1, py1, edge)
        meet = (boxes & (np.sign(side) * np.sign(cross(px2, py2, edge)) <= 0)
                & (np.sign(cross(edge[0], edge[1], seg)) * np.sign(cross(edge[2], edge[3], seg)) <= 0))
        close = meet | point(px1, py1, edge) | point(px2, py2, edge) | point(edge[0], edge[1], seg) | point(edge[2], edge[3], seg)
        at = np.cumsum(m) - m
        return np.logical_or.reduceat(close, at) | ((np.minimum.reduceat(side, at) >= 0) & self.solid[h])


class _Ways:
    """Ways of a cell in tiles: sorted into strips by x and by y in a strip, ``TILE`` at a time."""

    def __init__(self, t: pa.Table):
        segs = _column(t, "wsegs")
        count = np.asarray(segs.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        first = np.cumsum(count) - count
        box = [_numbers(_column(t, c)) for c in ("wx0", "wy0", "wx1", "wy1")]
        n = len(count)
        deep = TILE * -(-n // (TILE * max(1, int(np.sqrt(n / TILE)))))  # ways of a strip: whole tiles
        rank = np.empty(n, dtype=np.int64)
        rank[np.argsort(box[0] + box[2], kind="stable")] = np.arange(n)
        order = np.lexsort((box[1] + box[3], rank // deep))
        _, at = _runs(first[order], count[order])
        flat = segs.flatten()
        self.x1, self.y1, self.x2, self.y2, self.len, self.glen = (_numbers(flat.field(c))[at] for c in ("x1", "y1", "x2", "y2", "len", "glen"))
        self.count = count[order]
        self.first = np.cumsum(self.count) - self.count
        self.box = [b[order] for b in box]
        self.copies = _numbers(_column(t, "_copies"))[order]
        self.id = np.asarray(_column(t, "osm_id").to_numpy(zero_copy_only=False), dtype=np.int64)[order]
        names = _column(t, "name").to_pylist()
        self.names = sorted({v for v in names if v is not None})
        code = {v: i for i, v in enumerate(self.names)}
        self.code = np.array([-1 if v is None else code[v] for v in names], dtype=np.int64)[order]
        self.noname = self.code < 0
        self.total = [np.nan_to_num(np.add.reduceat(v, self.first) * self.copies) for v in (self.len, self.glen)]
        self.tile = np.arange(0, n, TILE)
        self.in_tile = np.minimum(TILE, n - self.tile)
        self.tile_box = [f.reduceat(b, self.tile) for f, b in zip((np.minimum, np.minimum, np.maximum, np.maximum), self.box)]


class _Sums:
    """What the hulls of a batch have of the ways near them."""

    def __init__(self, hulls: int, ways: _Ways | None, listed: np.ndarray):
        self.w, self.listed, self.size = ways, listed, hulls
        self.sums = {c: np.zeros(hulls) for c in SUMS}
        self.counts = {c: np.zeros(hulls, dtype=np.int64) for c in COUNTS}
        self.one, self.one_noname = np.full(hulls, NONE), np.full(hulls, NONE)
        self.named = np.zeros((hulls, len(ways.names) if ways else 0), dtype=bool)
        self.lists: list = []

    def add(self, h: np.ndarray, w: np.ndarray, near: np.ndarray | None = None, inside: np.ndarray | None = None) -> None:
        """Pairs of a hull and a way near it, with the lengths within reach and inside (the whole, if not given)."""
        if not len(h):
            return
        ways = self.w
        lens = (ways.total[0][w], ways.total[0][w] if near is None else np.nan_to_num(near), ways.total[1][w],
                ways.total[1][w] if inside is None else np.nan_to_num(inside))
        nn = ways.noname[w]
        for c, v in zip(SUMS, lens):
            self.sums[c] += np.bincount(h, v, self.size)
            self.sums["n" + c] += np.bincount(h[nn], v[nn], self.size)
        for c, some in zip(COUNTS, (h, h[nn], h[~nn])):
            self.counts[c] += np.bincount(some, minlength=self.size)
        np.maximum.at(self.one, h, ways.id[w])
        np.maximum.at(self.one_noname, h[nn], ways.id[w][nn])
        hn, code = h[~nn], ways.code[w][~nn]
        self.named[hn, code] = True
        if self.listed.any():
            self.lists.append((hn[self.listed[hn]], code[self.listed[hn]]))


def _batch(hulls: _Hulls, ways: _Ways, listed: np.ndarray) -> _Sums:
    out = _Sums(len(hulls.m), ways, listed)
    tiles = [b[None, :] for b in ways.tile_box]
    h, t = np.nonzero(hulls.in_reach(np.arange(len(hulls.m))[:, None], tiles))
    for some in _chunks(hulls.m[h] * TILE, ROWS):
        hs, ts = h[some], t[some]
        inside, far = hulls.sides(hs, [b[ts] for b in ways.tile_box])
        pair, w = _runs(ways.tile[ts[inside]], ways.in_tile[ts[inside]])
        out.add(hs[inside][pair], w)
        rest = ~inside & ~far
        pair, w = _runs(ways.tile[ts[rest]], ways.in_tile[ts[rest]])
        _border(hulls, ways, hs[rest][pair], w, out)
    return out


def _border(hulls: _Hulls, ways: _Ways, h: np.ndarray, w: np.ndarray, out: _Sums) -> None:
    """Pairs of a hull and a way about its border."""
    met = hulls.in_reach(h, [b[w] for b in ways.box])
    h, w = h[met], w[met]
    if not len(h):
        return
    inside, far = hulls.sides(h, [b[w] for b in ways.box])
    out.add(h[inside], w[inside])
    rest = ~inside & ~far
    h, w = h[rest], w[rest]
    for some in _chunks(hulls.m[h] * ways.count[w], ROWS):
        hs, ws = h[some], w[some]
        pair, s = _runs(ways.first[ws], ways.count[ws])
        x1, y1, x2, y2 = ways.x1[s], ways.y1[s], ways.x2[s], ways.y2[s]
        box = (np.minimum(x1, x2), np.minimum(y1, y2), np.maximum(x1, x2), np.maximum(y1, y2))
        hp = hs[pair]
        whole, beyond = hulls.sides(hp, box)
        near, inner = whole.astype(float), whole.astype(float)
        todo = np.flatnonzero(~whole & ~beyond & (hulls.in_reach(hp, box) | np.isnan(x1 + x2 + y1 + y2)))
        if len(todo):
            near[todo], inner[todo] = hulls.clip(hp[todo], x1[todo], y1[todo], x2[todo], y2[todo])
        close = np.zeros(len(hs), dtype=bool)
        close[pair[near > CLEAR]] = True
        todo = todo[~close[pair[todo]]]
        if len(todo):
            found = hulls.near(hp[todo], x1[todo], y1[todo], x2[todo], y2[todo])
            close[pair[todo[found]]] = True
        # as sums in the order of the segments, so that they do not depend on what else is in the chunk
        first = np.cumsum(ways.count[ws]) - ways.count[ws]
        lb = np.add.reduceat(ways.len[s] * near, first) * ways.copies[ws]
        gh = np.add.reduceat(ways.glen[s] * inner, first) * ways.copies[ws]
        out.add(hs[close], ws[close], lb[close], gh[close])


_SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _fits(named: np.ndarray, patterns: list, names: list) -> np.ndarray:
    """Hulls that have a name with their pattern in it (without quotes, letters A-Z in either case); a pattern and a name
    are compared once."""
    plain = {p: i for i, p in enumerate(dict.fromkeys(p for p in patterns if p is not None))}
    at = np.array([-1 if p is None else plain[p] for p in patterns], dtype=np.int64)
    h, c = np.nonzero(named & (at >= 0)[:, None])
    asked, back = np.unique(at[h] * max(len(names), 1) + c, return_inverse=True)
    pats, low = list(plain), [v.replace('"', "").translate(_SMALL) for v in names]
    yes = np.array([pats[k // len(names)] in low[k % len(names)] for k in asked.tolist()], dtype=bool)
    out = np.zeros(len(patterns), dtype=bool)
    if len(asked):
        out[h[yes[back]]] = True
    return out


def _measured(keys: list, dist: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(groups: pa.Table, ways: pa.Table) -> pa.Table:
        parts = []
        if groups.num_rows and ways.num_rows:
            w = _Ways(ways)
            step = max(1, BATCH // max(len(w.tile), len(w.names)))
            with np.errstate(all="ignore"):
                parts = [_part(groups.slice(i, step), w, keys, dist) for i in range(0, groups.num_rows, step)]
        if not parts:
            return _rows(groups.slice(0, 0), keys, _Sums(0, None, np.zeros(0, dtype=bool)), np.zeros(0, dtype=bool))
        return pa.concat_tables(parts)

    return run


def _part(groups: pa.Table, ways: _Ways, keys: list, dist: float) -> pa.Table:
    patterns = _column(groups, "_pattern").to_pylist()
    sums = _batch(_Hulls(_column(groups, "hrings"), dist), ways, np.array([p is None for p in patterns]))
    return _rows(groups, keys, sums, _fits(sums.named, patterns, ways.names))


def _rows(groups: pa.Table, keys: list, s: _Sums, fits: np.ndarray) -> pa.Table:
    some = np.flatnonzero(s.counts["n"])
    last = s.named.shape[1] - 1 - np.argmax(s.named[some][:, ::-1], axis=1) if s.named.shape[1] else np.zeros(len(some), dtype=np.int64)
    has = s.counts["n_named"][some] > 0
    listed: dict = {}
    for h, code in s.lists:
        for i, c in zip(h.tolist(), code.tolist()):
            listed.setdefault(i, []).append(s.w.names[c])
    cols = {k: groups[k].take(pa.array(some)) for k in keys}
    cols |= {c: pa.array(s.counts[c][some], pa.int64()) for c in COUNTS}
    cols |= {c: pa.array(v[some], pa.int64(), mask=v[some] == NONE) for c, v in (("one", s.one), ("one_noname", s.one_noname))}
    cols["name"] = pa.array([s.w.names[i] if h else None for i, h in zip(last.tolist(), has.tolist())], pa.string())
    cols["fits"] = pa.array(fits[some], pa.bool_())
    cols["names"] = pa.array([listed.get(i) for i in some.tolist()], pa.list_(pa.string()))
    cols |= {c: pa.array(s.sums[c][some], pa.float64()) for c in SUMS}
    return pa.table(cols)


def hull_way_sums(hulls: DataFrame, ways: DataFrame, dist: float, key: tuple[str, ...]) -> DataFrame:
    """One row a hull with ways within ``dist``: ``n`` of them (``n_noname`` without a name, ``n_named`` with one), the id
    where it is one (``one``, ``one_noname``), the largest ``name``, the lengths on the plane and on the ground, all
    (``sl``, ``sg``), within ``dist`` (``slb``) and inside (``sgh``), with ``n`` before them for ways without a name.
    ``fits``: a name holds ``_pattern``; ``names``: all names, of hulls without a pattern.

    hulls: key, hrings (one closed counter-clockwise convex ring), its box hx0, hy0, hx1, hy1, _pattern; ways: osm_id, name,
    _copies, wsegs (array of x1, y1, x2, y2, len, glen) and the box wx0, wy0, wx1, wy1.
    """
    sizes = grid.level_sizes(CELL, 3)
    top = len(sizes)
    ways = ways.where("osm_id IS NOT NULL AND size(wsegs) > 0 AND wx0 IS NOT NULL AND wy0 IS NOT NULL")
    extent = "greatest(wx1 - wx0, wy1 - wy0)"
    ways = ways.withColumn("_level", F.expr(f"CASE WHEN {extent} > {sizes[-1]} THEN {top} ELSE {grid.level_of(extent, sizes)} END"))
    middle = lambda a, b: ("CASE _level " + " ".join(f"WHEN {i} THEN {grid.cell_of(f'(({a} + {b}) / 2.0)', s)}" for i, s in enumerate(sizes))
                           + " ELSE 0L END")
    levels = sorted(r[0] for r in ways.select("_level").distinct().collect())  # four at most
    ways = ways.select(F.col("_level"), F.expr(middle("wx0", "wx1")).alias("_cx"), F.expr(middle("wy0", "wy1")).alias("_cy"),
                       F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("_share"),
                       F.col("osm_id").cast("bigint").alias("osm_id"), "name", "_copies", "wsegs",
                       *[F.col(c).cast("double").alias(c) for c in ("wx0", "wy0", "wx1", "wy1")])
    # a way reaches half a cell beyond its own at most; cells beyond an edge of the hull are out of reach
    ring = "hrings[0]"
    a, b = f"{ring}[i_ - 1]", f"{ring}[i_]"
    ux, uy = f"({b}.x - {a}.x)", f"({b}.y - {a}.y)"
    slack = dist * (1 + 1e-9) + 1e-6

    def reach(i: int) -> str:
        if i == top:
            return f"array(named_struct('k', {i}, 'cx', 0L, 'cy', 0L))"
        s = sizes[i]
        beyond = (f"{ux} * ((c_.cy + 0.5D) * {s} - {a}.y) - {uy} * ((c_.cx + 0.5D) * {s} - {a}.x) "
                  f"+ {s} * (abs({ux}) + abs({uy})) + {slack} * sqrt({ux} * {ux} + {uy} * {uy}) < 0")
        met = f"NOT exists(sequence(1, size({ring}) - 1), i_ -> {beyond})"
        return (f"transform(filter({grid.box_cover('hx0', 'hy0', 'hx1', 'hy1', s, slack + s / 2)}, c_ -> {met}), "
                f"c_ -> named_struct('k', {i}, 'cx', c_.cx, 'cy', c_.cy))")

    cells = f"concat({', '.join(map(reach, levels))})" if levels else "cast(array() AS array<struct<k:int,cx:bigint,cy:bigint>>)"
    hulls = hulls.select(*key, "hrings", "_pattern", F.expr(f"pmod(xxhash64({', '.join(key)}), {SHARES})").cast("int").alias("_share"),
                         F.explode(F.expr(cells)).alias("_c"))
    hulls = hulls.select(F.col("_c.k").alias("_level"), F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"), "_share", *key, "hrings", "_pattern")
    place = ["_level", "_cx", "_cy", "_share"]
    # small inputs beside the work on their pairs: partitions are not put together by their bytes
    n = int(ways.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hulls, ways = hulls.repartition(n, *place), ways.repartition(n, *place)
    ship_package(ways.sparkSession)
    types = dict(hulls.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in key] + [f"{c} bigint" for c in (*COUNTS, "one", "one_noname")]
                       + ["name string", "fits boolean", "names array<string>"] + [f"{c} double" for c in SUMS])
    parts = hulls.groupBy(*place).cogroup(ways.groupBy(*place)).applyInArrow(_measured(list(key), float(dist)), schema)
    total = parts.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in (*COUNTS, *SUMS)], F.max("one").alias("one"), F.max("one_noname").alias("one_noname"),
        F.max("name").alias("name"), F.max("fits").alias("fits"), F.flatten(F.collect_list("names")).alias("names"))
    lone = lambda c, n_: F.when(F.col(n_) == 1, F.col(c)).alias(c)
    return total.select(*key, *COUNTS, lone("one", "n"), lone("one_noname", "n_noname"), "name", "fits", "names", *SUMS[:4],
                        *[F.when(F.col("n_noname") > 0, F.col(c)).alias(c) for c in SUMS[4:]])
