"""Feature-table views of the fixtures in the column layout the checks expect.

Real deployments load the same layouts with ``geoqa.sources.readers``; the
checks never look at fixture-specific columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.plans.fixtures import fx


def buildings(spark: SparkSession, sf: str) -> DataFrame:
    """osm_id, building, xmin, ymin, xmax, ymax (rectangles)."""
    return fx(spark, sf, "fx_building").select(
        "osm_id", F.lit("yes").alias("building"),
        F.col("x0").alias("xmin"), F.col("y0").alias("ymin"),
        (F.col("x0") + F.col("w")).alias("xmax"), (F.col("y0") + F.col("h")).alias("ymax"))


def communes(spark: SparkSession, sf: str) -> DataFrame:
    """insee, dept, rings (polygon) and its bbox."""
    return fx(spark, sf, "fx_commune").select(
        "insee", "dept", "cadastre", "xmin", "ymin", "xmax", "ymax",
        F.expr(G.box_rings("xmin", "ymin", "xmax", "ymax")).alias("rings"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """One row per way segment: osm_id, seg, x1, y1, x2, y2, highway, name, ref."""
    return fx(spark, sf, "fx_segment")


def highways(spark: SparkSession, sf: str) -> DataFrame:
    return segments(spark, sf).where(F.col("highway").isNotNull())


def addresses(spark: SparkSession, sf: str) -> DataFrame:
    return fx(spark, sf, "fx_address")


def official_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return fx(spark, sf, "fx_official")


def official_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segments of the official road copy (consecutive vertices)."""
    v = official_vertices(spark, sf)
    a, b = v.alias("a"), v.alias("b")
    return (a.join(b, (F.col("a.cleabs") == F.col("b.cleabs")) & (F.col("b.k") == F.col("a.k") + 1))
             .select(F.col("a.cleabs").alias("cleabs"), F.col("a.k").alias("seg"),
                     F.col("a.x").alias("x1"), F.col("a.y").alias("y1"),
                     F.col("b.x").alias("x2"), F.col("b.y").alias("y2"),
                     F.col("a.nb_voies").alias("nb_voies"), F.col("a.num_route").alias("num_route"),
                     F.col("a.importance").alias("importance"), F.col("a.nature").alias("nature")))


def official_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Official roads as lines: cleabs, pts (ordered vertices) and attributes."""
    v = official_vertices(spark, sf)
    return (v.groupBy("cleabs")
             .agg(F.sort_array(F.collect_list(F.struct("k", "x", "y"))).alias("_p"),
                  F.first("nb_voies").alias("nb_voies"), F.first("num_route").alias("num_route"),
                  F.first("importance").alias("importance"), F.first("nature").alias("nature"), F.first("etat").alias("etat"),
                  F.first("itineraire").alias("itineraire"))
             .select("cleabs", F.expr("transform(_p, p -> named_struct('x', p.x, 'y', p.y))").alias("pts"),
                     "nb_voies", "num_route", "importance", "nature", "etat", "itineraire"))


def dense_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Official roads as lines, half of them with more than ten vertices: cleabs, pts."""
    v = fx(spark, sf, "fx_dense").groupBy("cleabs").agg(F.sort_array(F.collect_list(F.struct("k", "x", "y"))).alias("_p"))
    return v.select("cleabs", F.expr("transform(_p, p -> named_struct('x', p.x, 'y', p.y))").alias("pts"))


def osm_lines(spark: SparkSession, sf: str) -> DataFrame:
    """OSM ways as lines: osm_id, pts, highway, name, ref."""
    v = fx(spark, sf, "fx_vertex")
    return (v.groupBy("osm_id")
             .agg(F.sort_array(F.collect_list(F.struct("k", "x", "y"))).alias("_p"),
                  F.first("highway").alias("highway"), F.first("name").alias("name"),
                  F.first("ref").alias("ref"))
             .select("osm_id", F.expr("transform(_p, p -> named_struct('x', p.x, 'y', p.y))").alias("pts"),
                     "highway", "name", "ref"))


# Houses: a pentagon per building (roof apex above the rectangle); every
# fourth one has a 2x2 courtyard hole.
HOUSE_RINGS = """
case when osm_id % 4 = 0 then array(
  array(named_struct('x', x0, 'y', y0), named_struct('x', x0 + w, 'y', y0), named_struct('x', x0 + w, 'y', y0 + h),
        named_struct('x', x0 + osm_id % w, 'y', y0 + h + 1 + osm_id % 5), named_struct('x', x0, 'y', y0 + h),
        named_struct('x', x0, 'y', y0)),
  array(named_struct('x', x0 + 1, 'y', y0 + 1), named_struct('x', x0 + 3, 'y', y0 + 1),
        named_struct('x', x0 + 3, 'y', y0 + 3), named_struct('x', x0 + 1, 'y', y0 + 3),
        named_struct('x', x0 + 1, 'y', y0 + 1)))
else array(
  array(named_struct('x', x0, 'y', y0), named_struct('x', x0 + w, 'y', y0), named_struct('x', x0 + w, 'y', y0 + h),
        named_struct('x', x0 + osm_id % w, 'y', y0 + h + 1 + osm_id % 5), named_struct('x', x0, 'y', y0 + h),
        named_struct('x', x0, 'y', y0))) end"""

# Same houses as vertex rows (ring, i) for SQL oracles.
HOUSE_VERTEX_SQL = """
select osm_id, 0 as ring, 0 as i, x0 as x, y0 as y from fx_building
union all select osm_id, 0, 1, x0 + w, y0 from fx_building
union all select osm_id, 0, 2, x0 + w, y0 + h from fx_building
union all select osm_id, 0, 3, x0 + osm_id % w, y0 + h + 1 + osm_id % 5 from fx_building
union all select osm_id, 0, 4, x0, y0 + h from fx_building
union all select osm_id, 0, 5, x0, y0 from fx_building
union all select osm_id, 1, 0, x0 + 1, y0 + 1 from fx_building where osm_id % 4 = 0
union all select osm_id, 1, 1, x0 + 3, y0 + 1 from fx_building where osm_id % 4 = 0
union all select osm_id, 1, 2, x0 + 3, y0 + 3 from fx_building where osm_id % 4 = 0
union all select osm_id, 1, 3, x0 + 1, y0 + 3 from fx_building where osm_id % 4 = 0
union all select osm_id, 1, 4, x0 + 1, y0 + 1 from fx_building where osm_id % 4 = 0"""

HOUSE_EDGE_SQL = """
select a.osm_id, a.ring, a.i, a.x as x1, a.y as y1, b.x as x2, b.y as y2
from fx_house_v a join fx_house_v b on a.osm_id = b.osm_id and a.ring = b.ring and b.i = a.i + 1"""


def houses(spark: SparkSession, sf: str) -> DataFrame:
    return fx(spark, sf, "fx_building").select("osm_id", "highway", F.expr(HOUSE_RINGS).alias("rings"))


def house_footprints(spark: SparkSession, sf: str) -> DataFrame:
    """osm_id, building, rings (footprint with courtyards) and its bounding box."""
    h = houses(spark, sf).withColumn("building", F.lit("yes"))
    for name, e in zip(("xmin", "ymin", "xmax", "ymax"), G.rings_bbox("rings")):
        h = h.withColumn(name, F.expr(e))
    return h


# Per house for SQL oracles: bounding box, area and centroid from the vertex and edge rows.
HOUSE_BOX_SQL = "select osm_id, min(x) as bx0, min(y) as by0, max(x) as bx1, max(y) as by1 from fx_house_v group by osm_id"
HOUSE_SHAPE_SQL = """
select osm_id, sum(case when ring = 0 then a else -a end) as area,
       sum(case when ring = 0 then mx else -mx end) / sum(case when ring = 0 then a else -a end) as gx,
       sum(case when ring = 0 then my else -my end) / sum(case when ring = 0 then a else -a end) as gy
from (select osm_id, ring, abs(sum(x1 * y2 - x2 * y1)) / 2.0 as a,
             sign(sum(x1 * y2 - x2 * y1)) * sum((x1 + x2) * (x1 * y2 - x2 * y1)) / 6.0 as mx,
             sign(sum(x1 * y2 - x2 * y1)) * sum((y1 + y2) * (x1 * y2 - x2 * y1)) / 6.0 as my
      from fx_house_e group by osm_id, ring) r group by osm_id"""
HOUSE_CTES = (("fx_house_v", HOUSE_VERTEX_SQL), ("fx_house_e", HOUSE_EDGE_SQL), ("hb", HOUSE_BOX_SQL), ("hs", HOUSE_SHAPE_SQL))


def in_house_sql(px: str, py: str, house: str) -> str:
    """Oracle: a point lies in a house (edge included), by winding the edges with atan2-free crossing counts."""
    on = (f"exists (select 1 from fx_house_e e where e.osm_id = {house} and (e.x2 - e.x1) * ({py} - e.y1) = (e.y2 - e.y1) * ({px} - e.x1) "
          f"and {px} between least(e.x1, e.x2) and greatest(e.x1, e.x2) and {py} between least(e.y1, e.y2) and greatest(e.y1, e.y2))")
    odd = (f"(select count(*) from fx_house_e e where e.osm_id = {house} and (e.y1 <= {py}) <> (e.y2 <= {py}) "
           f"and {px} < e.x1 + (e.x2 - e.x1) * cast({py} - e.y1 as double) / (e.y2 - e.y1)) % 2 = 1")
    return f"({on} or {odd})"


def clamp_d2_sql(px: str, py: str, e: str) -> str:
    """Oracle: squared distance of a point to an edge row, by the clamped projection."""
    l2 = f"greatest(({e}.x2 - {e}.x1) * ({e}.x2 - {e}.x1) + ({e}.y2 - {e}.y1) * ({e}.y2 - {e}.y1), 1e-30)"
    t = f"least(1.0, greatest(0.0, (({px} - {e}.x1) * ({e}.x2 - {e}.x1) + ({py} - {e}.y1) * ({e}.y2 - {e}.y1)) / {l2}))"
    return (f"(power({px} - {e}.x1 - {t} * ({e}.x2 - {e}.x1), 2) + power({py} - {e}.y1 - {t} * ({e}.y2 - {e}.y1), 2))")


TAG_KEYS = ("lanes", "old_ref", "nat_ref", "power", "waterway", "route", "junction", "access", "location")


def osm_ways(spark: SparkSession, sf: str) -> DataFrame:
    """OSM ways: osm_id, highway (class), name, ref, tags map, pts (line)."""
    w = fx(spark, sf, "fx_way")
    entries = ", ".join(f"named_struct('k', '{k}', 'v', {k})" for k in TAG_KEYS)
    w = w.select("osm_id", F.col("hw_class").alias("highway"), "name", "ref",
                 F.expr(f"map_from_entries(transform(filter(array({entries}), e -> e.v IS NOT NULL), "
                        f"e -> struct(e.k, e.v)))").alias("tags"))
    lines = osm_lines(spark, sf).select("osm_id", "pts")
    return w.join(lines.hint("merge"), "osm_id")  # both sides grow with the input: neither goes through the driver as a broadcast


def osm_way_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segment rows of the OSM ways with way attributes (osm_id, seg, x1..y2, highway, name, ref, tags)."""
    w = osm_ways(spark, sf)
    s = w.select("osm_id", "highway", "name", "ref", "tags", F.explode(F.expr(
        "transform(sequence(1, size(pts) - 1), i -> named_struct('seg', i - 1, 'x1', pts[i-1].x, 'y1', pts[i-1].y, "
        "'x2', pts[i].x, 'y2', pts[i].y))")).alias("s"))
    return s.select("osm_id", F.col("s.seg").alias("seg"), "s.x1", "s.y1", "s.x2", "s.y2",
                    "highway", "name", "ref", "tags")
