"""Attribute-driven checks: C4, C14, C15, C16, C17, C21."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.functions import text as T
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Box, Point
from geoqa.plans import inputs
from geoqa.plans.checks_common import (DEPT_POLY, DEPT_SQL, departments, lonlat_cols, lonlat_sql,
                                       two_stage_pairs, with_midpoint)
from geoqa.plans.fixtures import fx, register
from geoqa.plans.ops_joins import SEG_S, band, ref_keyed_segments
from geoqa.plans.registry import query
from geoqa.plans.sqlkit import line_ctes


# ---------------------------------------------------------------- C14
def populated_square_no_road(squares: DataFrame, size: int = 500) -> DataFrame:
    """7170/1 and /10: census squares with no highway; class 1 when the
    rounded-up population exceeds 5, else class 10 (one scan for both); by
    class, then square."""
    s = squares.where(F.col("highways") == 0).withColumn("pop_c", F.ceil("pop").cast("bigint"))
    s = s.withColumn("class", F.when(F.col("pop_c") > 5, 1).otherwise(10))
    s = s.withColumn("mx", F.col("cx") * size + size / 2).withColumn("my", F.col("cy") * size + size / 2)
    return s.select(F.concat_ws("_", F.col("cx").cast("string"), F.col("cy").cast("string")).alias("square_id"), "class", "pop_c",
                    *lonlat_cols("mx", "my")).orderBy("class", "square_id")


@query("c14_populated_square_no_road", f"""
select concat_ws('_', cx, cy) as square_id, case when ceil(pop) > 5 then 1 else 10 end as class,
       cast(ceil(pop) as bigint) as pop_c, {lonlat_sql('cx * 500 + 250.0', 'cy * 500 + 250.0')}
from fx_square where highways = 0""")
def c14(spark: SparkSession, sf: str) -> DataFrame:
    return populated_square_no_road(fx(spark, sf, "fx_square"))


# ---------------------------------------------------------------- C17
def name_equals_ref(ways: DataFrame, areas: DataFrame) -> DataFrame:
    """7170/3: highways whose name is their number (spaces ignored), with the
    midpoint strictly inside a level-6 area.  Fix: delete ``name``."""
    w = ways.where(F.col("highway").isNotNull() & F.col("ref").rlike(T.REF_PREFIX_PATTERN)
                   & (T.strip_spaces("ref") == T.strip_spaces("name")))
    m = with_midpoint(w).drop("pts", "tags")
    j = SJ.contains_join(m, areas, ("dept",), point=Point("mx", "my"), polygon=DEPT_POLY, boundary=False)
    return j.select("osm_id", "ref", "name", *lonlat_cols("mx", "my"), F.lit("delete name").alias("fix"))


@query("c17_name_equals_ref", f"""
select w.osm_id, w.ref, w.name, {lonlat_sql('m.x', 'm.y')}, 'delete name' as fix
from fx_way w join w_mid m on m.id = w.osm_id join dep d on m.x > d.xmin and m.x < d.xmax and m.y > d.ymin and m.y < d.ymax
where w.highway is not null and regexp_matches(w.ref, '{T.REF_PREFIX_PATTERN}')
and replace(w.ref, ' ', '') = replace(w.name, ' ', '')""",
       line_ctes("w", "fx_vertex", "osm_id") + (("dep", DEPT_SQL),))
def c17(spark: SparkSession, sf: str) -> DataFrame:
    return name_equals_ref(inputs.osm_ways(spark, sf), departments(spark, sf))


# ---------------------------------------------------------------- C16
def missing_lanes_a(official: DataFrame, way_segs: DataFrame, dist: float = 100.0) -> DataFrame:
    """7170/20: midpoint of 3/4-lane official roads with a same-number
    highway within ``dist`` that has no ``lanes`` tag (one row per way)."""
    r = with_midpoint(official.where(F.col("nb_voies").rlike("^(3|4)"))).drop("pts")
    h = way_segs.where("highway IS NOT NULL").select("osm_id", "x1", "y1", "x2", "y2", "tags",
                                                     T.strip_spaces(F.upper("ref")).alias("rref"))
    j = SJ.dwithin_join(r, h, dist, left_geom=Point("mx", "my"),
                        residual="l.num_route = r.rref AND NOT map_contains_key(r.tags, 'lanes')")
    j = j.select("cleabs", "osm_id", "nb_voies", "mx", "my").distinct()
    return j.select("cleabs", "osm_id", "nb_voies", *lonlat_cols("mx", "my"))


@query("c16_missing_lanes_a", f"""
select distinct o.cleabs, s.osm_id, o.nb_voies, {lonlat_sql('m.x', 'm.y')}
from (select distinct cleabs, nb_voies, num_route from fx_official where regexp_matches(nb_voies, '^(3|4)')) o
join o_mid m on m.id = o.cleabs
join fx_segment s on {band('m.x', 'm.y', SEG_S, 100)} and {G.pt_seg_within('m.x', 'm.y', *SEG_S, '100')}
join fx_way w on w.osm_id = s.osm_id
where s.highway is not null and o.num_route = replace(upper(s.ref), ' ', '') and w.lanes is null""",
       line_ctes("o", "fx_official", "cleabs"))
def c16(spark: SparkSession, sf: str) -> DataFrame:
    return missing_lanes_a(inputs.official_lines(spark, sf), inputs.osm_way_segments(spark, sf))


# ---------------------------------------------------------------- C21
def missing_lanes_b(official: DataFrame, way_segs: DataFrame, coarse: float = 50.0, fine_m: float = 20.0) -> DataFrame:
    """7170/20 (second source): roads in service with 3 to 8 lanes (text
    comparison), matched to a same-number highway (whole line within
    ``coarse``, midpoint within ``fine_m`` m) that lacks ``lanes``."""
    o = official.where((F.col("etat") == "En service") & (F.col("nb_voies") > "2") & (F.col("nb_voies") < "9"))
    h = way_segs.where("highway IS NOT NULL AND osm_id > 0").select(
        "osm_id", "x1", "y1", "x2", "y2", T.strip_spaces("ref").alias("rref"))
    pairs = two_stage_pairs(o, h, line_id="cleabs", way_id="osm_id", coarse=coarse, fine_m=fine_m,
                            residual="l.num_route = r.rref")
    lacking = way_segs.where(~F.map_contains_key("tags", "lanes")).select("osm_id").distinct()
    m = with_midpoint(o).select("cleabs", "mx", "my", "nb_voies")
    j = pairs.join(lacking, "osm_id", "left_semi").join(m, "cleabs")
    j = j.select("osm_id", "mx", "my", F.format_string("lanes=%s ?", "nb_voies").alias("text")).distinct()
    return j.select("osm_id", *lonlat_cols("mx", "my"), "text")


@query("c21_missing_lanes_b", f"""
select distinct w.osm_id, {lonlat_sql('m.x', 'm.y')}, format('lanes={{}} ?', o.nb_voies) as text
from (select distinct cleabs, nb_voies, num_route from fx_official
      where etat = 'En service' and nb_voies > '2' and nb_voies < '9') o
join o_mid m on m.id = o.cleabs
join fx_segment s on {band('m.x', 'm.y', SEG_S, 25)} and {SJ.geo_pt_seg_within('m.x', 'm.y', SEG_S, '20.0')}
join fx_way w on w.osm_id = s.osm_id
where s.highway is not null and s.osm_id > 0 and o.num_route = replace(s.ref, ' ', '') and w.lanes is null
and exists (select 1 from o_seg t join fx_segment s2 on s2.osm_id = s.osm_id where t.id = o.cleabs
            and {G.seg_seg_within(('t.x1', 't.y1', 't.x2', 't.y2'), ('s2.x1', 's2.y1', 's2.x2', 's2.y2'), '50.0')})""",
       line_ctes("o", "fx_official", "cleabs"))
def c21(spark: SparkSession, sf: str) -> DataFrame:
    return missing_lanes_b(inputs.official_lines(spark, sf), inputs.osm_way_segments(spark, sf))


# ---------------------------------------------------------------- C15
def missing_road_ref(points: DataFrame, keyed_segs: DataFrame, dist: float = 300.0) -> DataFrame:
    """7170/2: sample points of numbered official roads with no highway
    within ``dist`` whose ref / old_ref / nat_ref normalises to the number;
    grouped by point with the sorted distinct numbers and road ids."""
    p = points.where(F.col("num_route").isNotNull() & (F.col("num_route") != ""))
    lonely = SJ.dwithin_join(p, keyed_segs, dist, residual="l.num_route = r.rkey", how="left_anti")
    g = lonely.groupBy("x", "y").agg(
        F.array_join(F.array_sort(F.collect_set(T.pretty_ref("num_route"))), ",").alias("refs"),
        F.array_join(F.array_sort(F.collect_set(F.col("cleabs").cast("string"))), ",").alias("ids"))
    return g.select(*lonlat_cols("x", "y"), "refs", "ids")


_N_REF = "regexp_replace(regexp_replace(upper(w.ref), '[^0-9A-Z.]', '', 'g'), '^M', 'D')"
_N_OLD = "regexp_replace(upper(w.old_ref), '[^0-9A-Z]', '', 'g')"
_N_NAT = "regexp_replace(upper(w.nat_ref), '[^0-9A-Z]', '', 'g')"
_PRETTY = "regexp_replace(v.num_route, '([A-Z]*)([0-9A-Z]*$)', '\\1 \\2')"


@query("c15_missing_road_ref", f"""
select {lonlat_sql('v.x', 'v.y')}, string_agg(distinct {_PRETTY}, ',' order by {_PRETTY}) as refs,
       string_agg(distinct cast(v.cleabs as varchar), ',' order by cast(v.cleabs as varchar)) as ids
from fx_official v where v.num_route is not null and v.num_route <> '' and v.k not in (
  select v2.k from fx_official v2 join fx_segment s on {band('v2.x', 'v2.y', SEG_S, 300)}
  join fx_way w on w.osm_id = s.osm_id
  where v2.cleabs = v.cleabs and w.highway is not null and w.ref is not null
  and (v2.num_route = {_N_REF} or v2.num_route = {_N_OLD} or v2.num_route = {_N_NAT})
  and {G.pt_seg_within('v2.x', 'v2.y', *SEG_S, '300')})
group by v.x, v.y""")
def c15(spark: SparkSession, sf: str) -> DataFrame:
    pts = inputs.official_vertices(spark, sf).select("cleabs", "k", "x", "y", "num_route")
    return missing_road_ref(pts, ref_keyed_segments(spark, sf))


# ---------------------------------------------------------------- C4
PHARMACY_ACTIVITY = "4773Z"  # fixed value: activity code of pharmacies in the register


def missing_pharmacy(registry: DataFrame, osm_points: DataFrame, osm_polygons: DataFrame,
                     margin: float = 200.0) -> DataFrame:
    """7170/99: registered pharmacies (activity code, a place, named without
    ``*``) with no OSM pharmacy point and no pharmacy polygon whose bbox meets
    the +-``margin`` square around them; the text gives name, address line and
    the 14-digit number (company number, then establishment number).

    registry: id, x, y, name, l4, siren, nic, apet700; the OSM tables have
    an ``amenity``."""
    r = registry.where((F.col("apet700") == PHARMACY_ACTIVITY) & F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.col("name").contains("*"))
    r = SJ.bbox_join(r, osm_points.where("amenity = 'pharmacy'"), margin, right_geom=Point(), how="left_anti")
    r = SJ.bbox_join(r, osm_polygons.where("amenity = 'pharmacy'"), margin, right_geom=Box(), how="left_anti")
    name = F.replace("name", F.lit('"'), F.lit(""))
    return r.select("id", *lonlat_cols("x", "y"), F.format_string("%s, %s - SIRET:%s%s", name, "l4", "siren", "nic").alias("text"))


REGISTRY_SQL = """
select id, x, y, concat('"PHARMACIE" ', cast(id as varchar(20)), case when id % 10 = 0 then ' *' else '' end) as name,
       concat(cast(1 + id % 90 as varchar(9)), ' RUE ', cast(street as varchar(20))) as l4,
       lpad(cast(id as varchar(20)), 9, '0') as siren, lpad(cast(id % 99999 as varchar(9)), 5, '0') as nic,
       case when source = '1-URGENT' then '4773Z' when source = '2-HIGH' then null else '4711D' end as apet700 from fx_address"""
AMENITY_POINT_SQL = "select osm_id, x, y, case when osm_id % 3 = 0 then 'pharmacy' when osm_id % 3 = 1 then 'bank' end as amenity from fx_poi"
AMENITY_AREA_SQL = """
select osm_id, x0 as xmin, y0 as ymin, x0 + w as xmax, y0 + h as ymax, case when osm_id % 50 = 0 then 'pharmacy' end as amenity from fx_building"""


@query("c04_missing_pharmacy", f"""
select a.id, {lonlat_sql('a.x', 'a.y')}, replace(a.name, '"', '') || ', ' || a.l4 || ' - SIRET:' || a.siren || a.nic as text
from reg a where a.apet700 = '4773Z' and a.name not like '%*%'
and not exists (select 1 from apt p where p.amenity = 'pharmacy' and p.x between a.x - 200 and a.x + 200
                and p.y between a.y - 200 and a.y + 200)
and not exists (select 1 from aar b where b.amenity = 'pharmacy' and b.xmin <= a.x + 200 and a.x - 200 <= b.xmax
                and b.ymin <= a.y + 200 and a.y - 200 <= b.ymax)""",
       (("reg", REGISTRY_SQL), ("apt", AMENITY_POINT_SQL), ("aar", AMENITY_AREA_SQL)))
def c04(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    return missing_pharmacy(spark.sql(REGISTRY_SQL), spark.sql(AMENITY_POINT_SQL).select("x", "y", "amenity"),
                            spark.sql(AMENITY_AREA_SQL).select("xmin", "ymin", "xmax", "ymax", "amenity"))
