"""Join operators (A1-A9, L1-L8) as plans over the fixtures.

Spark side: grid-cell equi-joins from ``geoqa.operators.sjoin``.  Oracle
side: plain brute-force SQL (every pair tested), which checks the grid
cover, the cell de-duplication and the anti/semi shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.functions import text as T
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Box, Point, Polygon, Segment
from geoqa.plans import inputs
from geoqa.plans.fixtures import fx
from geoqa.plans.registry import query

SEG_S = ("s.x1", "s.y1", "s.x2", "s.y2")


def band(px: str, py: str, seg: tuple, d) -> str:
    """Oracle pre-filter: the point lies in the segment bbox expanded by d
    (lets DuckDB plan an inequality join instead of testing every pair)."""
    x1, y1, x2, y2 = seg
    return (f"least({x1}, {x2}) - {d} <= {px} and {px} <= greatest({x1}, {x2}) + {d} and "
            f"least({y1}, {y2}) - {d} <= {py} and {py} <= greatest({y1}, {y2}) + {d}")


def _communes_poly(spark, sf):
    c = inputs.communes(spark, sf)
    return c.select("insee", "rings", F.col("xmin").alias("cxmin"), F.col("ymin").alias("cymin"),
                    F.col("xmax").alias("cxmax"), F.col("ymax").alias("cymax"))


COMMUNE_POLY = Polygon("rings", ("cxmin", "cymin", "cxmax", "cymax"))


# ------------------------------------------------------------------ A1 A2
@query("point_in_polygon", """
select a.id, c.insee from fx_address a join fx_commune c
on a.x between c.xmin and c.xmax and a.y between c.ymin and c.ymax""")
def point_in_polygon(spark: SparkSession, sf: str) -> DataFrame:
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    j = SJ.contains_join(a, _communes_poly(spark, sf), ("insee",), polygon=COMMUNE_POLY, boundary=True)
    return j.select("id", "insee")


@query("strict_contains", """
select a.id, c.insee from fx_address a join fx_commune c
on a.x > c.xmin and a.x < c.xmax and a.y > c.ymin and a.y < c.ymax""")
def strict_contains(spark: SparkSession, sf: str) -> DataFrame:
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    j = SJ.contains_join(a, _communes_poly(spark, sf), ("insee",), polygon=COMMUNE_POLY, boundary=False)
    return j.select("id", "insee")


# ------------------------------------------------------------------ A3
@query("dwithin_join", f"""
select a.id, s.osm_id, s.seg, round(sqrt({G.pt_seg_d2('a.x', 'a.y', *SEG_S)}), 6) as dist
from fx_address a join fx_segment s on {G.pt_seg_within('a.x', 'a.y', *SEG_S, '40')}
where s.highway is not null""")
def dwithin_pairs(spark: SparkSession, sf: str) -> DataFrame:
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    s = inputs.highways(spark, sf).select("osm_id", "seg", "x1", "y1", "x2", "y2")
    j = SJ.dwithin_join(a, s, 40, distance_col="d")
    return j.select("id", "osm_id", "seg", F.round("d", 6).alias("dist"))


# ------------------------------------------------------------------ A4
@query("nearest_vertex", f"""
select cleabs, cast(k as bigint) as k, osm_id, round(d, 6) as dist from (
  select v.cleabs, v.k, s.osm_id, sqrt({G.pt_seg_d2('v.x', 'v.y', *SEG_S)}) as d,
         row_number() over (partition by v.cleabs, v.k order by {G.pt_seg_d2('v.x', 'v.y', *SEG_S)}, s.osm_id, s.seg) as rn
  from fx_official v join fx_segment s on {G.pt_seg_within('v.x', 'v.y', *SEG_S, '100')}
  where s.highway is not null and v.k > 0 and v.k < 3) z
where rn = 1""")
def nearest_vertex(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest highway (within 100) of every inner official vertex."""
    v = inputs.official_lines(spark, sf).select("cleabs", "pts", F.size("pts").alias("n"))
    v = (v.select("cleabs", "n", F.posexplode("pts").alias("k", "p"))
          .where((F.col("k") > 0) & (F.col("k") < F.col("n") - 1))
          .select("cleabs", F.col("k").cast("bigint").alias("k"), F.col("p.x").alias("x"), F.col("p.y").alias("y")))
    s = inputs.highways(spark, sf).select("osm_id", "seg", "x1", "y1", "x2", "y2")
    # the smallest distance first, by a hash aggregate that keeps one number a vertex; then the pairs at that distance:
    # no sort, spill or shuffle of all pairs within 100
    least = SJ.dwithin_join(v, s, 100, distance_col="d").groupBy("cleabs", "k").agg(F.min("d").alias("_least"))
    at = SJ.dwithin_join(v.join(least, ["cleabs", "k"]), s, 100, residual=f"sqrt({SJ.dist2_sql(Point(), Segment())}) = l._least")
    best = at.groupBy("cleabs", "k").agg(F.min(F.struct("osm_id", "seg")).alias("_s"), F.first("_least").alias("d"))
    return best.select("cleabs", "k", F.col("_s.osm_id").alias("osm_id"), F.round("d", 6).alias("dist"))


@query("nearest_any", f"""
select p.osm_id, round(sqrt(min({G.pt_seg_d2('p.x', 'p.y', *SEG_S)})), 6) as dist
from fx_poi p cross join fx_segment s where s.highway is not null group by p.osm_id""")
def nearest_any(spark: SparkSession, sf: str) -> DataFrame:
    """Distance of every shop to its nearest highway, however far (rings of cells that grow)."""
    p = fx(spark, sf, "fx_poi").select("osm_id", "x", "y")
    s = inputs.highways(spark, sf).select("x1", "y1", "x2", "y2")
    return SJ.nearest_join(p, s, key=("osm_id",), start=50.0).select("osm_id", F.round("d", 6).alias("dist"))


# ------------------------------------------------------------------ A5
@query("dwithin_anti", f"""
select a.id from fx_address a where not exists (
  select 1 from fx_segment s where s.highway is not null and {G.pt_seg_within('a.x', 'a.y', *SEG_S, '150')})""")
def dwithin_anti(spark: SparkSession, sf: str) -> DataFrame:
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    s = inputs.highways(spark, sf).select("x1", "y1", "x2", "y2")
    return SJ.dwithin_join(a, s, 150, how="left_anti").select("id")


# ------------------------------------------------------------------ A6
_GEO_A6 = SJ.geo_pt_seg_within("a.x", "a.y", SEG_S, "110", "<")


@query("twostage_anti", f"""
select a.id from fx_address a where a.id not in (
  select a.id from fx_address a join fx_segment s on {band('a.x', 'a.y', SEG_S, 150)}
  where s.highway is not null and {G.pt_seg_within('a.x', 'a.y', *SEG_S, '150')} and {_GEO_A6})""")
def twostage_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Coarse planar 150 then geodesic < 110 m (address without road)."""
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    s = inputs.highways(spark, sf).select("x1", "y1", "x2", "y2")
    fine = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), "110", "<", scales=SJ.L_SCALES)
    return SJ.dwithin_join(SJ.with_geo_scales(a, "y"), s, 150, how="left_anti", residual=fine).select("id")


# ------------------------------------------------------------------ A8
@query("bbox_overlap", """
select distinct p.osm_id as poi, s.osm_id as way from fx_poi p join fx_segment s
on least(s.x1, s.x2) <= p.x + 200 and p.x - 200 <= greatest(s.x1, s.x2)
and least(s.y1, s.y2) <= p.y + 200 and p.y - 200 <= greatest(s.y1, s.y2)""")
def bbox_overlap(spark: SparkSession, sf: str) -> DataFrame:
    p = fx(spark, sf, "fx_poi").select(F.col("osm_id").alias("poi"), "x", "y")
    s = inputs.segments(spark, sf).select(F.col("osm_id").alias("way"), "x1", "y1", "x2", "y2")
    return SJ.bbox_key_pairs(p, s, "poi", "way", 200)


@query("bbox_anti", """
select p.osm_id from fx_poi p where not exists (select 1 from fx_segment s
where s.highway is null and least(s.x1, s.x2) <= p.x + 200 and p.x - 200 <= greatest(s.x1, s.x2)
and least(s.y1, s.y2) <= p.y + 200 and p.y - 200 <= greatest(s.y1, s.y2))""")
def bbox_anti(spark: SparkSession, sf: str) -> DataFrame:
    p = fx(spark, sf, "fx_poi").select("osm_id", "x", "y")
    s = inputs.segments(spark, sf).where("highway IS NULL").select("x1", "y1", "x2", "y2")
    return SJ.bbox_join(p, s, 200, right_geom=Segment(), how="left_anti").select("osm_id")


# ------------------------------------------------------------------ A9
def _corner_in_house(px: str, py: str) -> str:
    """Crossing parity of a box corner against a house's edges (oracle)."""
    return f"""((select count(*) from fx_house_e e where e.osm_id = h.osm_id
  and ((e.y1 > {py}) <> (e.y2 > {py}))
  and ((e.x2 - e.x1) * ({py} - e.y1) - ({px} - e.x1) * (e.y2 - e.y1)) * sign(e.y2 - e.y1) > 0) % 2 = 1)"""


@query("polygon_intersects", f"""
select distinct h.osm_id, c.insee from (select distinct osm_id from fx_house_e) h cross join fx_commune c
where exists (select 1 from fx_house_e e where e.osm_id = h.osm_id
              and {G.seg_intersects_box(('e.x1', 'e.y1', 'e.x2', 'e.y2'), ('c.xmin', 'c.ymin', 'c.xmax', 'c.ymax'))})
   or {_corner_in_house('c.xmin', 'c.ymin')}""",
       (("fx_house_v", inputs.HOUSE_VERTEX_SQL), ("fx_house_e", inputs.HOUSE_EDGE_SQL)))
def polygon_intersects(spark: SparkSession, sf: str) -> DataFrame:
    h = inputs.houses(spark, sf)
    return SJ.polygons_intersect_join(h, _communes_poly(spark, sf), left_key=("osm_id",), right_key=("insee",),
                                      right_geom=COMMUNE_POLY).select("osm_id", "insee")


# ------------------------------------------------------------------ L1
@query("anti_key", """
select distinct a.fantoir, a.voie from fx_street_address a
where a.fantoir not in (select fantoir from fx_status where statut = 5)""")
def anti_key(spark: SparkSession, sf: str) -> DataFrame:
    a = fx(spark, sf, "fx_street_address").select("fantoir", "voie")
    status = fx(spark, sf, "fx_status").where("statut = 5").select("fantoir")
    return a.join(status, "fantoir", "left_anti").distinct()


# ------------------------------------------------------------------ L2
@query("join_tag_key", """
select o.cleabs, w.osm_id from (select distinct cleabs, num_route from fx_official) o
join fx_way w on o.num_route = replace(upper(w.ref), ' ', '') where w.highway is not null""")
def join_tag_key(spark: SparkSession, sf: str) -> DataFrame:
    o = inputs.official_vertices(spark, sf).select("cleabs", "num_route").distinct()
    w = inputs.osm_ways(spark, sf).where("highway IS NOT NULL").select(
        "osm_id", T.strip_spaces(F.upper("ref")).alias("num_route"))
    return pairs_by_key(w, o, "num_route").select("cleabs", "osm_id")


#: Rows of one key that stand together in the pairs of ``pairs_by_key``, and shares in which a key's rows are dealt out.
RUN, SHARES = 128, 8


def pairs_by_key(many: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key`` whose result grows with the square of a key's rows, in an order that takes little to write.

    ``RUN`` rows of ``many`` come with one row of ``other`` after the other: what repeats is near, so column files
    need a small part of the bytes of the pairs.  The inputs are small beside the pairs: partitions are not put
    together by their bytes, and a key's rows are dealt to ``SHARES`` places.  No task holds all rows of a key."""
    n = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in many.columns if c != key]
    own = many.where(F.col(key).isNotNull()).select(key, F.struct(*names).alias("_row"), F.spark_partition_id().alias("_part"))
    rows = own.groupBy(key, "_part").agg(F.collect_list("_row").alias("_rows"))  # of one partition: bounded by its size
    cut = f"transform(sequence(0, (size(_rows) - 1) div {RUN}), i_ -> slice(_rows, i_ * {RUN} + 1, {RUN}))"
    runs = rows.select(key, "_part", F.posexplode(F.expr(cut)).alias("_i", "_run"))
    runs = runs.select(key, F.expr(f"pmod(_part + _i, {SHARES})").alias("_share"), "_run").repartition(n, key, "_share")
    other = other.where(F.col(key).isNotNull()).withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))).repartition(n, key, "_share")
    met = runs.join(other.hint("merge"), [key, "_share"]).drop("_share")
    return met.withColumn("_row", F.explode("_run")).select("*", "_row.*").drop("_row", "_run")


# ------------------------------------------------------------------ L3
_NORM_REF = "regexp_replace(regexp_replace(upper(w.ref), '[^0-9A-Z.]', '', 'g'), '^M', 'D')"
_NORM_OLD = "regexp_replace(upper(w.old_ref), '[^0-9A-Z]', '', 'g')"
_NORM_NAT = "regexp_replace(upper(w.nat_ref), '[^0-9A-Z]', '', 'g')"


@query("ref_multikey_join", f"""
select distinct v.cleabs, v.k, s.osm_id from fx_official v
join fx_way w on (v.num_route = {_NORM_REF} or v.num_route = {_NORM_OLD} or v.num_route = {_NORM_NAT})
join fx_segment s on s.osm_id = w.osm_id
where w.highway is not null and w.ref is not null and {G.pt_seg_within('v.x', 'v.y', *SEG_S, '300')}""")
def ref_multikey_join(spark: SparkSession, sf: str) -> DataFrame:
    """Official vertex -> OSM highway within 300 whose ref, old_ref or
    nat_ref normalises to the official number (OR of keys as one exploded key)."""
    v = inputs.official_vertices(spark, sf).select("cleabs", "k", "x", "y", "num_route")
    s = ref_keyed_segments(spark, sf)
    j = SJ.dwithin_join(v, s, 300, residual="l.num_route = r.rkey")
    return j.select("cleabs", "k", "osm_id").distinct()


def ref_keyed_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Highway segments exploded by their candidate route keys (ref, old_ref, nat_ref)."""
    s = inputs.osm_way_segments(spark, sf).where("highway IS NOT NULL AND ref IS NOT NULL")
    keys = F.array_distinct(F.filter(F.array(T.normalise_ref("ref"),
                                             T.normalise_alt_ref(F.element_at("tags", "old_ref")),
                                             T.normalise_alt_ref(F.element_at("tags", "nat_ref"))),
                                     lambda k: k.isNotNull()))
    return s.select("osm_id", "seg", "x1", "y1", "x2", "y2", F.explode(keys).alias("rkey"))


# ------------------------------------------------------------------ L4
@query("ref_distance_join", f"""
select distinct v.cleabs, s.osm_id from fx_official v join fx_segment s
on v.num_route = replace(upper(s.ref), ' ', '') and {G.pt_seg_within('v.x', 'v.y', *SEG_S, '100')}
where s.highway is not null""")
def ref_distance_join(spark: SparkSession, sf: str) -> DataFrame:
    v = inputs.official_vertices(spark, sf).select("cleabs", "x", "y", "num_route")
    s = inputs.highways(spark, sf).select("osm_id", "x1", "y1", "x2", "y2",
                                          T.strip_spaces(F.upper("ref")).alias("rref"))
    j = SJ.dwithin_join(v, s, 100, residual="l.num_route = r.rref")
    return j.select("cleabs", "osm_id").distinct()


# ------------------------------------------------------------------ L8
@query("exists_flag", f"""
select a.id, exists (select 1 from fx_segment s join fx_way w on w.osm_id = s.osm_id and w.location = 'underground' where s.highway is not null
                     and {G.pt_seg_within('a.x', 'a.y', *SEG_S, '50')}) as near_underground
from fx_address a""")
def exists_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Flag each address near (<= 50) an 'underground' line, without
    multiplying rows: semi-join the key set, then a left join adds the flag."""
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    s = inputs.osm_way_segments(spark, sf).where("highway IS NOT NULL AND tags['location'] = 'underground'").select("x1", "y1", "x2", "y2")
    near = SJ.dwithin_join(a, s, 50, how="left_semi").select("id", F.lit(True).alias("near_underground"))
    return a.join(near, "id", "left").select("id", F.coalesce("near_underground", F.lit(False)).alias("near_underground"))
