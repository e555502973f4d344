"""Distance clustering (connected components of the "within d" graph) and
cluster centroids, as Spark jobs.

Plan
----
1. Grid of side ``d / sqrt(2)``: two points in one cell are always within
   ``d``, so a cell is a clique and is represented by its smallest id.  A
   dense cell costs one partial aggregate, never all pairs inside it.
2. Cell-to-cell edges: the 12 "forward" neighbour cells of the 5x5 block
   around a cell meet it as boxes around their points.  Boxes that are wholly
   within or beyond ``d`` are decided without looking at a point; few points
   are compared; two dense boxes are split in four and meet again, part by part,
   until they are decided (:func:`_near_cells`).  So the points of two dense
   cells whose gap is just over ``d`` are never all compared with each other.
3. Connected components of the cell graph: tiles of 64 x 64 cells are
   contracted independently with a vectorised pandas union-find (a tile of one
   group at a time, whatever the density and the number of groups), then min-label
   propagation with pointer jumping runs in Spark on the tile-crossing edges
   only; the label table is cached each round and reliably checkpointed to the
   session's checkpoint folder every third round, so lineage stays short and a
   lost executor only recomputes a few rounds.  The input points are checkpointed
   once so the rounds never recompute the upstream joins.
4. Each point takes its cell's component label; the cluster id is the
   smallest member id, so results do not depend on partitioning.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoqa.functions import geom as G
from geoqa.operators import sjoin as SJ
from geoqa.session import ensure_checkpoint_dir, ship_package


def connected_components(edges: DataFrame, nodes: DataFrame, src: str = "src", dst: str = "dst",
                         node: str = "node", checkpoint_every: int = 3) -> DataFrame:
    """Label every node with the smallest node id of its component.

    ``edges``: undirected pairs (either direction is enough); ``nodes``: all
    node ids (isolated ones included).  Returns ``node, label``.
    """
    spark = nodes.sparkSession
    ensure_checkpoint_dir(spark)
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = e.checkpoint(eager=True)
    labels = nodes.select(F.col(node).alias("node")).distinct().withColumn("label", F.col("node"))
    labels = labels.checkpoint(eager=True)
    if e.isEmpty():
        return labels
    for r in itertools.count(1):  # until nothing changes: labels only fall
        # 1. min label over neighbours
        nb = (e.join(labels.withColumnRenamed("node", "b"), "b")
               .groupBy("a").agg(F.min("label").alias("nl")))
        step = (labels.join(nb, labels.node == nb.a, "left")
                .select("node", F.least("label", F.coalesce("nl", "label")).alias("label")))
        # 2. pointer jumping: adopt the label of your label
        hop = step.select(F.col("node").alias("lnode"), F.col("label").alias("ll"))
        new = (step.join(hop, step.label == hop.lnode, "left")
               .select("node", F.least("label", F.coalesce("ll", "label")).alias("label")))
        # reliable checkpoint every few rounds bounds lineage (and recomputation
        # after a lost executor); in between the round result is cached
        new = new.checkpoint(eager=True) if r % checkpoint_every == 0 else new.persist(StorageLevel.MEMORY_AND_DISK)
        changed = (new.join(labels.withColumnRenamed("label", "old"), "node")
                   .where(F.col("label") != F.col("old")).limit(1).count())
        labels.unpersist()
        labels = new
        if changed == 0:
            out = labels.checkpoint(eager=True)
            labels.unpersist()
            return out


def _offsets(d: float, reach: float, size: float) -> list:
    """Forward cell offsets whose cells can hold a partner: anchors of two
    partners differ by at most ``d + reach`` along each axis."""
    k = int(math.ceil((d + reach) / size))
    out = []
    for dx in range(-k, k + 1):
        for dy in range(-k, k + 1):
            if not (dx > 0 or (dx == 0 and dy > 0)):
                continue
            gx, gy = max(0, abs(dx) - 1) * size, max(0, abs(dy) - 1) * size
            if gx <= d + reach and gy <= d + reach:
                out.append((dx, dy))
    return out


def cluster_within(points: DataFrame, dist: float, *, id_col: str = "id", x: str = "x", y: str = "y",
                   group_by: tuple[str, ...] = (), out: str = "cluster_id",
                   box: tuple[str, str, str, str] | None = None, rings: str | None = None) -> DataFrame:
    """ST_ClusterWithin as a table operator: every input row gets the id of
    its cluster (smallest member id).  Rows are clustered separately per
    ``group_by`` key (e.g. department, route); a NULL key is a key.

    ``box=(xmin, ymin, xmax, ymax)`` clusters rectangles by their gap distance
    instead of points, and with ``rings`` the polygons inside these boxes by
    their exact distance; ``x, y`` must then be a point of each (a corner, a
    vertex).  Shapes wider than ``dist`` (blocks, whole towns) meet the others
    on all the cells they cover, so no size is refused.
    """
    d = float(dist)
    size = d / math.sqrt(2) * (1 - 1e-12)
    geom = SJ.Polygon("_r", ("_b0", "_b1", "_b2", "_b3")) if rings else SJ.Box("_b0", "_b1", "_b2", "_b3") if box else SJ.Point("_x", "_y")
    shape = ["_x", "_y"] + ([f"_b{i}" for i in range(4)] if box else []) + (["_r"] if rings else [])
    p = points.select(*([F.to_json(F.struct(*group_by)).alias("_g")] if group_by else []),  # text that is never NULL
                      F.col(id_col).alias("_id"), F.col(x).alias("_x"), F.col(y).alias("_y"),
                      *([F.col(c).alias(f"_b{i}") for i, c in enumerate(box)] if box else []), *([F.col(rings).alias("_r")] if rings else []),
                      F.struct(*[F.col(c) for c in points.columns]).alias("_orig"))
    gcols = ["_g"] if group_by else []
    p = (p.withColumn("_gx", F.floor(F.col("_x").cast("double") / size))
          .withColumn("_gy", F.floor(F.col("_y").cast("double") / size)))
    # the iterative part runs several jobs: materialise the input once (reliable
    # checkpoint in the shared folder) instead of recomputing its plan per job
    ensure_checkpoint_dir(points.sparkSession)
    p = p.checkpoint(eager=True)
    cells = p.groupBy(*gcols, "_gx", "_gy").agg(F.min("_id").alias("_rep"))
    hits = _near_shapes(p, geom, shape, d, size, gcols) if box else _near_cells(p.select(*gcols, "_gx", "_gy", "_x", "_y"), d, size, gcols)
    cell_label = _label_cells(cells, hits.checkpoint(eager=True), gcols).withColumnRenamed("_label", out)
    # rows come back from the checkpointed input (original columns kept in it)
    return p.join(cell_label, [*gcols, "_gx", "_gy"]).select(*[F.col("_orig." + c).alias(c) for c in points.columns],
                                                             F.col(out))


#: Points of two boxes are compared one by one up to so many pairs; boxes with more are split.
SPLIT = 4096


def _neighbours(d: float, reach: float, size: float):
    return F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _offsets(d, reach, size)])


def _near_cells(points: DataFrame, d: float, size: float, gcols: list, split: int = SPLIT) -> DataFrame:
    """Pairs of neighbouring cells (``_gx, _gy``; ``_tx, _ty``) with two points (``_x, _y``) within ``d``, each once.

    A dual descent of quarters: a pair of boxes (the extent of their points) is near if even its farthest corners are,
    and not if its nearest sides are not; what is left is compared point by point if it is at most ``split`` pairs, else
    by its quarters in the next round, unless the cells are already known to be near.  Rounds end when no such pair is
    left, at the first one for cells of up to 64 points; equal points need none.
    """
    cell_pair = [*gcols, "_gx", "_gy", "_tx", "_ty"]
    extent = [F.count("*").alias("n"), F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1")]
    gap = lambda c: f"greatest(0, b.{c}0 - a.{c}1, a.{c}0 - b.{c}1)"
    span = lambda c: f"greatest(b.{c}1 - a.{c}0, a.{c}1 - b.{c}0)"
    square = lambda f: f"({f('x')} * {f('x')} + {f('y')} * {f('y')})"
    limit = f"({d!r}) * ({d!r})"

    def state(deepest: bool) -> str:
        few = "true" if deepest else f"a.n * b.n <= {split}"
        return (f"CASE WHEN {square(gap)} > {limit} THEN NULL WHEN {square(span)} <= {limit} THEN 'near' "
                f"WHEN {few} THEN 'compare' ELSE 'split' END")

    def boxes(df: DataFrame, name: str, *keys) -> DataFrame:
        """Extents of the points by ``_ix, _iy`` as struct ``name``, beside ``keys``."""
        e = df.groupBy(*gcols, "_ix", "_iy").agg(*extent)
        return e.select(*gcols, *keys, F.struct(F.col("_ix").alias("ix"), F.col("_iy").alias("iy"), "n", "x0", "x1", "y0", "y1").alias(name))

    def on_side(name: str, df: DataFrame) -> DataFrame:
        return df.select(*gcols, F.col(f"{name}.ix").alias("_ix"), F.col(f"{name}.iy").alias("_iy"))

    pts = points.withColumn("_ix", F.col("_gx")).withColumn("_iy", F.col("_gy"))
    a = boxes(pts, "a", F.col("_ix").alias("_gx"), F.col("_iy").alias("_gy")).withColumn("_o", F.explode(_neighbours(d, 0.0, size)))
    a = a.select(*gcols, "_gx", "_gy", (F.col("_gx") + F.col("_o.dx")).alias("_tx"), (F.col("_gy") + F.col("_o.dy")).alias("_ty"), "a")
    pairs = a.join(boxes(pts, "b", F.col("_ix").alias("_tx"), F.col("_iy").alias("_ty")), [*gcols, "_tx", "_ty"])
    hits = None
    for depth in itertools.count():
        pairs = pairs.withColumn("_state", F.expr(state(depth >= 48))).where("_state IS NOT NULL").checkpoint(eager=True)
        few = pairs.where("_state = 'compare'").select(*cell_pair, F.col("a.ix").alias("_ix"), F.col("a.iy").alias("_iy"), F.struct("b.ix", "b.iy").alias("_b"))
        few = few.join(pts.select(*gcols, "_ix", "_iy", "_x", "_y"), [*gcols, "_ix", "_iy"]).alias("l")
        near = [f"l.`{g}` = r.`{g}`" for g in gcols] + ["l._b.ix = r._ix", "l._b.iy = r._iy", SJ.within_sql(SJ.Point("_x", "_y"), SJ.Point("_x", "_y"), repr(d))]
        found = few.join(pts.alias("r"), F.expr(" AND ".join(near)), "left_semi").select(*cell_pair)
        found = pairs.where("_state = 'near'").select(*cell_pair).unionByName(found).distinct()
        hits = found if hits is None else hits.unionByName(found).distinct()
        dense = pairs.where("_state = 'split'")
        if dense.isEmpty():
            return hits
        hits = hits.checkpoint(eager=True)
        dense = dense.join(hits, cell_pair, "left_anti").checkpoint(eager=True)
        wanted = on_side("a", dense).unionByName(on_side("b", dense)).distinct()
        side = size / 2.0 ** (depth + 1)
        pts = (pts.join(wanted, [*gcols, "_ix", "_iy"], "left_semi")
                  .withColumn("_ix", F.floor(F.col("_x").cast("double") / side)).withColumn("_iy", F.floor(F.col("_y").cast("double") / side))
                  .checkpoint(eager=True))
        for name in ("a", "b"):
            up = [F.floor(F.col(i) / 2).alias(f"_{name}{i}") for i in ("_ix", "_iy")]
            dense = (dense.withColumn(f"_{name}_ix", F.col(f"{name}.ix")).withColumn(f"_{name}_iy", F.col(f"{name}.iy")).drop(name)
                     .join(boxes(pts, name, *up), [*gcols, f"_{name}_ix", f"_{name}_iy"]))
        pairs = dense.select(*cell_pair, "a", "b")


def _near_shapes(p: DataFrame, geom, shape: list, d: float, size: float, gcols: list) -> DataFrame:
    """Pairs of different cells with two shapes within ``d``: small ones by neighbour cells, wider ones by a distance join."""
    small = p.where("greatest(_b2 - _b0, _b3 - _b1) <= " + repr(d))
    probe = (small.select(*gcols, "_gx", "_gy", *shape, F.explode(_neighbours(d, d, size)).alias("_o"))
             .select(*gcols, "_gx", "_gy", *shape,
                     (F.col("_gx") + F.col("_o.dx")).alias("_tx"), (F.col("_gy") + F.col("_o.dy")).alias("_ty")))
    target = small.select(*gcols, F.col("_gx").alias("_tx"), F.col("_gy").alias("_ty"), *shape)
    cond = F.expr(" AND ".join([f"l.`{c}` = r.`{c}`" for c in [*gcols, "_tx", "_ty"]] + [SJ.within_sql(geom, geom, repr(d))]))
    hits = probe.alias("l").join(target.alias("r"), cond, "left_semi").select(*gcols, "_gx", "_gy", "_tx", "_ty")
    large = p.where("greatest(_b2 - _b0, _b3 - _b1) > " + repr(d)).select(*gcols, "_gx", "_gy", *shape)
    others = p.select(*gcols, F.col("_gx").alias("_tx"), F.col("_gy").alias("_ty"), *shape)
    far = SJ.dwithin_join(large, others, d, left_geom=geom, right_geom=geom, cell=2 * d, right_prefix="q",
                          residual=" AND ".join([f"l.`{g}` = r.`{g}`" for g in gcols]) or None)
    far = far.where("_gx <> _tx or _gy <> _ty").select(*gcols, "_gx", "_gy", "_tx", "_ty")
    return hits.unionByName(far).distinct()


TILE = 64  # cells per tile side: a tile holds at most TILE**2 nodes, whatever the data


def _tile_components(gcols: list):
    """Pandas function over rows sorted by group and tile: connected
    components of the cells of each tile over the edges inside it (vectorised
    min-label propagation with pointer jumping).  Returns each cell with the
    smallest representative id of its tile-local component.  Whole tiles of a
    batch are labelled together; only the last one waits for the next batch."""

    def run(batches):
        held = None
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = np.ones(len(pdf), dtype=bool)
            for c in [*gcols, "_ux", "_uy"]:
                last &= (pdf[c] == pdf[c].iat[-1]).to_numpy()
            held = pdf[last]
            if not last.all():
                yield label(pdf[~last])
        if held is not None:
            yield label(held)

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = pdf[pdf["_kind"] == 0].sort_values("_rep")
        edges = pdf[pdf["_kind"] == 1]
        lab = np.arange(len(nodes))
        if len(edges):
            def mi(df, a, b):
                return pd.MultiIndex.from_arrays([df[g].to_numpy() for g in gcols] + [df[a].to_numpy(), df[b].to_numpy()])
            pos = pd.Series(lab, index=mi(nodes, "_gx", "_gy"))
            s = pos.reindex(mi(edges, "_gx", "_gy")).to_numpy()
            t = pos.reindex(mi(edges, "_tx", "_ty")).to_numpy()
            while True:
                m = np.minimum(lab[s], lab[t])
                new = lab.copy()
                np.minimum.at(new, s, m)
                np.minimum.at(new, t, m)
                while True:
                    jumped = new[new]
                    if np.array_equal(jumped, new):
                        break
                    new = jumped
                if np.array_equal(new, lab):
                    break
                lab = new
        out = nodes[gcols + ["_gx", "_gy"]].copy()
        out["_lrep"] = nodes["_rep"].to_numpy()[lab]
        return out

    return run


def _label_cells(cells: DataFrame, hits: DataFrame, gcols: list) -> DataFrame:
    """Component label (smallest member id) of every cell.

    1. Tiles of TILE x TILE cells of one group are contracted independently, tile after
       tile (bounded: a dense city is many tiles, and many groups in one place are, too).
    2. Only edges that cross tiles enter the iterative Spark job, on the
       contracted graph, so it needs far fewer rounds.
    """
    def tile(cx, cy):
        return [F.floor(F.col(cx) / TILE).alias("_ux"), F.floor(F.col(cy) / TILE).alias("_uy")]

    cells = cells.withColumn("_rep", F.col("_rep").cast("long"))

    same_tile = ((F.floor(F.col("_gx") / TILE) == F.floor(F.col("_tx") / TILE))
                 & (F.floor(F.col("_gy") / TILE) == F.floor(F.col("_ty") / TILE)))
    node_rows = cells.select(*gcols, *tile("_gx", "_gy"), F.lit(0).alias("_kind"), "_gx", "_gy",
                             F.lit(None).cast("long").alias("_tx"), F.lit(None).cast("long").alias("_ty"), "_rep")
    edge_rows = hits.where(same_tile).select(*gcols, *tile("_gx", "_gy"), F.lit(1).alias("_kind"), "_gx", "_gy",
                                             F.col("_tx").cast("long"), F.col("_ty").cast("long"),
                                             F.lit(None).cast("long").alias("_rep"))
    schema = T.StructType([cells.schema[g] for g in gcols] + [
        T.StructField("_gx", T.LongType()), T.StructField("_gy", T.LongType()), T.StructField("_lrep", T.LongType())])
    ship_package(cells.sparkSession)  # the pandas function lives in this package
    tiles = [*gcols, "_ux", "_uy"]
    local = (node_rows.unionByName(edge_rows).repartition(*tiles).sortWithinPartitions(*tiles)
             .mapInPandas(_tile_components(gcols), schema)).checkpoint(eager=True)

    # graph nodes are (group, representative id): ids only need to be unique within a group
    def key(rep: str):
        return F.struct(*[F.col(g) for g in gcols], F.col(rep).alias("_rep")) if gcols else F.col(rep)

    la = local.select(*gcols, "_gx", "_gy", key("_lrep").alias("src"))
    lb = local.select(*gcols, F.col("_gx").alias("_tx"), F.col("_gy").alias("_ty"), key("_lrep").alias("dst"))
    cross = hits.where(~same_tile)
    redges = cross.join(la, [*gcols, "_gx", "_gy"]).join(lb, [*gcols, "_tx", "_ty"]).select("src", "dst")
    redges = redges.where(F.col("src") != F.col("dst")).distinct()
    rnodes = redges.select(F.col("src").alias("node")).unionByName(redges.select(F.col("dst").alias("node")))
    comp = connected_components(redges, rnodes)
    final = (local.withColumn("_node", key("_lrep")).join(comp, F.col("_node") == comp.node, "left")
             .withColumn("_fin", F.coalesce(F.col("label"), F.col("_node"))))
    lab = F.col("_fin._rep") if gcols else F.col("_fin")
    return final.select(*gcols, "_gx", "_gy", lab.alias("_label"))


def cluster_centroid(clustered: DataFrame, *, cluster: str = "cluster_id", x: str = "x", y: str = "y",
                     weight: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean point of each cluster, or the ``weight``-weighted mean
    (area-weighted centroid of a polygon collection).  Partial aggregation:
    a huge cluster never gathers its members in one place."""
    if weight:
        w = F.col(weight)
        aggs = [(F.sum(F.col(x) * w) / F.sum(w)).alias("cx"), (F.sum(F.col(y) * w) / F.sum(w)).alias("cy")]
    else:
        aggs = [F.avg(F.col(x).cast("double")).alias("cx"), F.avg(F.col(y).cast("double")).alias("cy")]
    return clustered.groupBy(*keys, cluster).agg(*aggs, F.count("*").alias("n"))
