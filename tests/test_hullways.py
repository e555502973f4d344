"""Ways against hulls, summed up by cell, against the same measures pair by pair in SQL."""

import random

import numpy as np
from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.functions import lines as LN
from geoqa.operators import hull as HU
from geoqa.operators import sjoin as SJ
from geoqa.operators.hullways import SUMS, hull_way_sums
from geoqa.operators.sjoin import Polygon, Segment
from geoqa.plans import checks_street

SF = "/root/testdata/sf0.001"
POINT = "struct<x: double, y: double>"


def _hulls(spark, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(40):
        span = (60, 900, 9000)[i % 3]  # within a cell, about one, over many
        cx, cy = rnd.randint(-5000, 5000), rnd.randint(-5000, 5000)
        pts = [(cx + rnd.randint(-span, span), cy + rnd.randint(-span, span)) for _ in range(2 if i % 5 == 0 else 9)]
        ring = [tuple(map(float, p)) for p in HU.monotone_chain(np.array(pts, dtype=float))]
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        rows.append((f"{i:05d}", "Rue 5" if i % 2 else "R.e 5", [[*ring, ring[0]]], min(xs), min(ys), max(xs), max(ys)))
    return spark.createDataFrame(rows, f"fantoir string, voie string, hrings array<array<{POINT}>>, hx0 double, hy0 double, hx1 double, hy1 double")


def _ways(spark, n=1500, seed=8):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x, y, pts = rnd.randint(-8000, 8000), rnd.randint(-8000, 8000), []
        reach = 20000 if i % 50 == 0 else 3000 if i % 10 == 0 else 60
        for _ in range(rnd.randint(1, 5)):
            pts.append((float(x), float(y)))
            if rnd.random() < 0.9:  # else the same place again
                x, y = x + rnd.randint(-reach, reach), y + rnd.randint(-reach, reach)
        rows.append((i, None if i % 7 == 0 else f"rue {i % 9}", 1 + i % 2, pts))
    w = spark.createDataFrame(rows, f"osm_id long, name string, _copies int, pts array<{POINT}>")
    segs = (f"transform({LN.line_to_segments('pts')}, w_ -> named_struct('x1', w_.x1, 'y1', w_.y1, 'x2', w_.x2, 'y2', w_.y2, "
            "'len', sqrt(power(w_.x2 - w_.x1, 2) + power(w_.y2 - w_.y1, 2)), 'glen', 0.7D * sqrt(power(w_.x2 - w_.x1, 2) + power(w_.y2 - w_.y1, 2))))")
    return w.withColumn("wsegs", F.expr(segs)).select("*", *[F.expr(e).alias(c) for e, c in zip(LN.bbox("pts"), ("wx0", "wy0", "wx1", "wy1"))])


def _pair_by_pair(hulls, ways):
    seg, own = ("w_.x1", "w_.y1", "w_.x2", "w_.y2"), ("hx0", "hy0", "hx1", "hy1")
    near = f"exists(l.wsegs, w_ -> {SJ.within_sql(Polygon('hrings', own), Segment(), '20.0', rp='w_')})"
    j = hulls.crossJoin(ways).withColumn("hull", F.col("hrings")[0]).withColumn("solid", F.size("hull") > 3)
    cut = (f"transform(wsegs, w_ -> named_struct('len', w_.len, 'glen', w_.glen, 'b', CASE WHEN {G.box_overlap(own, G.seg_bbox(*seg), '20')} "
           f"THEN {LN.clip_buffer(*seg, 'hull', 20.0, 'solid')} END, 'h', CASE WHEN solid THEN {LN.clip_convex(*seg, 'hull')} END))")
    j = j.alias("l").where(f"size(wsegs) > 0 AND {near}").withColumn("_cut", F.explode(F.array(F.expr(cut))))
    share = lambda p: f"coalesce(greatest(c_.{p}.hi - c_.{p}.lo, 0D), 0D)"
    for c, e in zip(SUMS, ("c_.len", f"c_.len * {share('b')}", "c_.glen", f"c_.glen * {share('h')}")):
        j = j.withColumn(c, F.expr(f"aggregate(_cut, 0D, (t_, c_) -> t_ + {e}) * _copies"))
    nn = F.col("name").isNull()
    return j.groupBy("fantoir").agg(
        F.count("*").alias("n"), F.count(F.when(nn, 1)).alias("n_noname"), F.max("name").alias("name"), F.max("osm_id").alias("last"),
        F.array_sort(F.collect_list("name")).alias("names"), *[F.sum(c).alias(c) for c in SUMS[:4]], *[F.sum(F.when(nn, F.col(c))).alias("n" + c) for c in SUMS[:4]])


def test_sums_by_cell_equal_pairs_in_sql(spark):
    hulls, ways = _hulls(spark), _ways(spark)
    pattern = F.when(F.col("voie") == "Rue 5", F.lit("rue 5"))
    got = {r.fantoir: r for r in hull_way_sums(hulls.withColumn("_pattern", pattern), ways, 20.0, ("fantoir", "voie")).collect()}
    want = {r.fantoir: r for r in _pair_by_pair(hulls, ways).collect()}
    assert set(got) == set(want) and max(r.n for r in want.values()) > 500
    for k, w in want.items():
        g = got[k]
        assert (g.n, g.n_noname, g.n_named, g.name) == (w.n, w.n_noname, w.n - w.n_noname, w.name)
        assert g.one == (w.last if w.n == 1 else None)
        if g.voie == "Rue 5":  # a plain pattern is looked for where the ways are, other names come along
            assert g.fits == ("rue 5" in w.names) and not g.names
        else:
            assert sorted(g.names) == w.names
        for c in SUMS:
            assert (g[c] is None and w[c] is None) or abs(g[c] - w[c]) <= 1e-9 * max(1.0, w["sl"])


def test_wide_hulls_make_no_row_a_pair(spark):
    """A hull meets cells, and what it has in common with the ways of a cell comes as one row."""
    plan = checks_street.overlap_ratio(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "wx0" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_names_are_compared_as_a_whole_and_by_sign(spark):
    ring = [(0.0, 0.0), (100.0, 0.0), (50.0, 50.0), (0.0, 0.0)]
    groups = spark.createDataFrame([(f"7505612{i}0A", v, 4, ring, 3) for i, v in enumerate(("RUE B", "rue b", "R.e a", "Rue Z", "a;Rue", 'Rue "B"', "b;rue"))],
                                   f"fantoir string, voie string, nb long, hull array<{POINT}>, nverts int")
    ways = spark.createDataFrame([(1, "Rue B", "service", [(0.0, 5.0), (90.0, 5.0)]), (2, "Rue a", "service", [(5.0, 0.0), (5.0, 900.0)])],
                                 f"osm_id long, name string, highway string, pts array<{POINT}>")
    status = spark.createDataFrame([("x",)], "fantoir string")
    out = checks_street.street_name_check(groups, status, ways)
    # those with a name that matches are dropped; a pattern with a sign is looked for across names (Rue B;Rue a)
    assert [(r.voie, r["class"]) for r in out.collect()] == [("Rue Z", 30), ("a;Rue", 30)]
