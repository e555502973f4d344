"""Clustering operators (A7, A11) as plans; the oracle computes connected
components with a keyed recursive CTE (semi-naive min-label propagation over
brute-force edges)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.operators import cluster as CL
from geoqa.operators import sjoin as SJ
from geoqa.plans import inputs
from geoqa.plans.ops_joins import SEG_S, band
from geoqa.plans.registry import query


def components_ctes(points: str, dist: int, group: str | None = None, pair: str | None = None,
                    band: int | None = None) -> tuple:
    """CTEs ``cc_e`` (edges within dist) and ``cc_lab`` ((g, id) -> smallest
    id of its component within group g) over a CTE ``points`` with columns
    id, x, y[, group].  ``pair`` replaces the point-distance test (over
    ``a.``/``b.``); ``band`` widens the coordinate pre-filter."""
    g = f"a.{group}" if group else "0"
    gb = f"b.{group}" if group else "0"
    w = band if band is not None else dist
    test = pair or G.pt_pt_within('a.x', 'a.y', 'b.x', 'b.y', str(dist))
    edges = (f"select {g} as g, a.id as s, b.id as t from {points} a join {points} b "
             f"on {g} = {gb} and a.x between b.x - {w} and b.x + {w} and a.y between b.y - {w} and b.y + {w} "
             f"where {test}")
    lab = (f"select distinct {'p.' + group if group else '0'}, p.id, p.id from {points} p union "
           f"select e.g, e.s, min(l.label) from cc_e e join cc_lab l on l.g = e.g and l.id = e.t "
           f"join recurring.cc_lab c on c.g = e.g and c.id = e.s "
           f"group by e.g, e.s, c.label having min(l.label) < c.label")
    return (("cc_e", edges), ("cc_lab(g, id, label) USING KEY (g, id)", lab))


_LONELY_SQL = f"""
select a.id, a.x, a.y from fx_address a where a.id not in (
  select a.id from fx_address a join fx_segment s on {band('a.x', 'a.y', SEG_S, 150)}
  where s.highway is not null and {G.pt_seg_within('a.x', 'a.y', *SEG_S, '150')})"""


def lonely_addresses(spark: SparkSession, sf: str) -> DataFrame:
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    s = inputs.highways(spark, sf).select("x1", "y1", "x2", "y2")
    return SJ.dwithin_join(a, s, 150, how="left_anti")


@query("cluster_within", "select id, label as cluster_id from cc_lab",
       (("lonely", _LONELY_SQL),) + components_ctes("lonely", 300))
def cluster_within(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses with no highway within 150, clustered at 300."""
    c = CL.cluster_within(lonely_addresses(spark, sf), 300)
    return c.select("id", "cluster_id")


@query("cluster_centroid", """
select l.label as cluster_id, round(avg(p.x), 6) as x, round(avg(p.y), 6) as y, count(*) as n
from cc_lab l join lonely p on p.id = l.id group by l.label""",
       (("lonely", _LONELY_SQL),) + components_ctes("lonely", 300))
def cluster_centroid(spark: SparkSession, sf: str) -> DataFrame:
    c = CL.cluster_within(lonely_addresses(spark, sf), 300)
    m = CL.cluster_centroid(c)
    return m.select("cluster_id", F.round("cx", 6).alias("x"), F.round("cy", 6).alias("y"), "n")
