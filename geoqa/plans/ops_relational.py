"""Predicates, aggregations, ordering and text functions (P*, AG*, O*, F*)
as plans over the fixtures.  These are Spark built-ins; the plans show the
exact semantics the checks rely on (three-valued logic, text ordering,
NULLs-first sorts, first-match regex rewrites)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.functions import text as T
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Box, Point, Polygon
from geoqa.plans import inputs
from geoqa.plans.fixtures import fx
from geoqa.plans.ops_joins import COMMUNE_POLY, SEG_S, _communes_poly, band
from geoqa.plans.registry import query


# ------------------------------------------------------------------ P2 P3
@query("filter_null_blank", """
select osm_id from fx_way where (power is null or power != 'line') and coalesce(lanes, '') = ''""")
def filter_null_blank(spark: SparkSession, sf: str) -> DataFrame:
    w = fx(spark, sf, "fx_way")
    return w.where((F.col("power").isNull() | (F.col("power") != "line")) & T.blank("lanes")).select("osm_id")


# ------------------------------------------------------------------ P4
@query("filter_like", """
select osm_id, hw_class, name from fx_way where hw_class like '%_link' or name like 'small%'""")
def filter_like(spark: SparkSession, sf: str) -> DataFrame:
    w = fx(spark, sf, "fx_way")
    return w.where(F.col("hw_class").like("%_link") | F.col("name").like("small%")).select("osm_id", "hw_class", "name")


# ------------------------------------------------------------------ P5
@query("filter_notin_null", """
select osm_id, shop from fx_poi where shop not in ('car', 'car_repair', 'kiosk')""")
def filter_notin_null(spark: SparkSession, sf: str) -> DataFrame:
    p = fx(spark, sf, "fx_poi")
    return p.where(~F.col("shop").isin(*T.EXCLUDED_SHOPS)).select("osm_id", "shop")


# ------------------------------------------------------------------ P6
@query("regex_filter", f"""
select osm_id, ref from fx_way where regexp_matches(ref, '{T.REF_PREFIX_PATTERN}') and not regexp_matches(name, 'RING', 'i')""")
def regex_filter(spark: SparkSession, sf: str) -> DataFrame:
    w = fx(spark, sf, "fx_way")
    return w.where(F.col("ref").rlike(T.REF_PREFIX_PATTERN) & ~F.col("name").rlike("(?i)RING")).select("osm_id", "ref")


# ------------------------------------------------------------------ P7
@query("regex_from_column", """
select distinct a.fantoir, a.voie from fx_street_address a join fx_way w on w.osm_id = a.fantoir
where regexp_matches(a.voie, regexp_replace(w.name, '[()]', '', 'g'), 'i')""")
def regex_from_column(spark: SparkSession, sf: str) -> DataFrame:
    """Street name matches the OSM name used as a case-insensitive pattern."""
    a = fx(spark, sf, "fx_street_address").select("fantoir", "voie").distinct()
    w = fx(spark, sf, "fx_way").select(F.col("osm_id").alias("fantoir"), "name")
    return a.join(w, "fantoir").where(T.matches_ci("voie", T.unbracket("name"))).select("fantoir", "voie")


# ------------------------------------------------------------------ P8 P9
@query("text_order_filter", """
select distinct cleabs, nb_voies, importance from fx_official
where (importance < '3' or nature like 'Route%' and nb_voies != '') and nb_voies > '2' and nb_voies < '9'""")
def text_order_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers kept as text compare as text ('10' < '9'); AND binds tighter than OR."""
    o = inputs.official_vertices(spark, sf)
    c = (((F.col("importance") < "3") | (F.col("nature").like("Route%") & (F.col("nb_voies") != "")))
         & (F.col("nb_voies") > "2") & (F.col("nb_voies") < "9"))
    return o.where(c).select("cleabs", "nb_voies", "importance").distinct()


# ------------------------------------------------------------------ P10
@query("map_key_missing", "select osm_id from fx_way where highway is not null and lanes is null")
def map_key_missing(spark: SparkSession, sf: str) -> DataFrame:
    w = inputs.osm_ways(spark, sf).where("highway IS NOT NULL")
    return w.where(~F.map_contains_key("tags", "lanes")).select("osm_id")


# ------------------------------------------------------------------ AG1
@query("having_pairs", """
select fantoir, voie, count(*) as n from fx_street_address
where coalesce(source, '') != 'CADASTRE' group by fantoir, voie having count(*) > 1""")
def having_pairs(spark: SparkSession, sf: str) -> DataFrame:
    a = fx(spark, sf, "fx_street_address").where(F.coalesce("source", F.lit("")) != "CADASTRE")
    return a.groupBy("fantoir", "voie").agg(F.count("*").alias("n")).where("n > 1")


# ------------------------------------------------------------------ AG2 AG3
_SQ_CENTRE = "select cx * 500 + 250 as x, cy * 500 + 250 as y, buildings from fx_square"


@query("half_share_having", f"""
select m.insee, m.nb, count(*) as total from (
  select c.insee, count(*) as nb from ({_SQ_CENTRE}) q join fx_commune c
  on q.x between c.xmin and c.xmax and q.y between c.ymin and c.ymax where q.buildings = 0 group by c.insee) m
join fx_commune c on c.insee = m.insee
join ({_SQ_CENTRE}) q on q.x between c.xmin and c.xmax and q.y between c.ymin and c.ymax
group by m.insee, m.nb having m.nb > cast(floor(count(*) / 2) as bigint)""")
def half_share_having(spark: SparkSession, sf: str) -> DataFrame:
    """Communes where squares without buildings outnumber half of all their
    squares (integer division), two aggregations over one containment join."""
    q = fx(spark, sf, "fx_square").select((F.col("cx") * 500 + 250).alias("x"), (F.col("cy") * 500 + 250).alias("y"),
                                          "buildings")
    j = SJ.contains_join(q, _communes_poly(spark, sf), ("insee",), polygon=COMMUNE_POLY)
    agg = j.groupBy("insee").agg(F.sum(F.when(F.col("buildings") == 0, 1).otherwise(0)).alias("nb"),
                                 F.count("*").alias("total"))
    return agg.where((F.col("nb") > 0) & (F.col("nb") > F.floor(F.col("total") / 2))).select(
        "insee", F.col("nb").cast("bigint").alias("nb"), "total")


# ------------------------------------------------------------------ AG4
@query("min_distance", """
select p.osm_id, round(min(sqrt(cast(
  greatest(b.x0 - p.x, 0, p.x - (b.x0 + b.w)) * greatest(b.x0 - p.x, 0, p.x - (b.x0 + b.w)) +
  greatest(b.y0 - p.y, 0, p.y - (b.y0 + b.h)) * greatest(b.y0 - p.y, 0, p.y - (b.y0 + b.h)) as double))), 6) as dist
from fx_poi p join fx_building b on b.x0 - 20 <= p.x and p.x <= b.x0 + b.w + 20 and b.y0 - 20 <= p.y and p.y <= b.y0 + b.h + 20
where greatest(b.x0 - p.x, 0, p.x - (b.x0 + b.w)) * greatest(b.x0 - p.x, 0, p.x - (b.x0 + b.w)) +
      greatest(b.y0 - p.y, 0, p.y - (b.y0 + b.h)) * greatest(b.y0 - p.y, 0, p.y - (b.y0 + b.h)) <= 400
group by p.osm_id""")
def min_distance(spark: SparkSession, sf: str) -> DataFrame:
    p = fx(spark, sf, "fx_poi").select("osm_id", "x", "y")
    b = inputs.buildings(spark, sf).select("xmin", "ymin", "xmax", "ymax")
    j = SJ.dwithin_join(p, b, 20, right_geom=Box(), distance_col="d")
    return j.groupBy("osm_id").agg(F.round(F.min("d"), 6).alias("dist"))


# ------------------------------------------------------------------ AG5 AG6
@query("agg_names_sorted", f"""
select v.cleabs, string_agg(s.name, ';' order by s.name) as names from (
  select distinct v.cleabs, s.osm_id from fx_official v join fx_segment s on {band('v.x', 'v.y', SEG_S, 20)}
  where {G.pt_seg_within('v.x', 'v.y', *SEG_S, '20')}) p
join fx_official v on v.cleabs = p.cleabs and v.k = 0
join (select distinct osm_id, name from fx_segment) s on s.osm_id = p.osm_id
group by v.cleabs""")
def agg_names_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Names of the OSM ways within 20 of any official vertex, one list per
    road (``string_agg``; sorted so the text is deterministic)."""
    v = inputs.official_vertices(spark, sf).select("cleabs", "x", "y")
    s = inputs.segments(spark, sf).select("osm_id", "name", "x1", "y1", "x2", "y2")
    pairs = SJ.dwithin_join(v, s, 20).select("cleabs", "osm_id", "name").distinct()
    return pairs.groupBy("cleabs").agg(F.array_join(F.array_sort(F.collect_list("name")), ";").alias("names"))


@query("agg_names_distinct", """
select c.insee, string_agg(distinct regexp_replace(o.num_route, '([A-Z]*)([0-9A-Z]*$)', '\\1 \\2'), ','
                           order by regexp_replace(o.num_route, '([A-Z]*)([0-9A-Z]*$)', '\\1 \\2')) as refs
from fx_official o join fx_commune c on o.x between c.xmin and c.xmax and o.y between c.ymin and c.ymax
where o.k = 0 and o.num_route like 'D%' group by c.insee""")
def agg_names_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct pretty road numbers per commune (``string_agg(distinct ...)``)."""
    o = inputs.official_vertices(spark, sf).where("k = 0 AND num_route LIKE 'D%'").select("num_route", "x", "y")
    j = SJ.contains_join(o, _communes_poly(spark, sf), ("insee",), polygon=COMMUNE_POLY)
    return j.groupBy("insee").agg(
        F.array_join(F.array_sort(F.collect_set(T.pretty_ref("num_route"))), ",").alias("refs"))


# ------------------------------------------------------------------ AG7 AG8
@query("dedupe_geometry", f"""
select distinct v.x, v.y from fx_official v where not exists (
  select 1 from fx_segment s where s.highway is not null and {G.pt_seg_within('v.x', 'v.y', *SEG_S, '25')})""")
def dedupe_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct vertex positions with no highway within 25 (group by geometry)."""
    v = inputs.official_vertices(spark, sf).select("x", "y")
    s = inputs.highways(spark, sf).select("x1", "y1", "x2", "y2")
    return SJ.dwithin_join(v, s, 25, how="left_anti").distinct()


# ------------------------------------------------------------------ O2
@query("order_nulls_first", """
select osm_id, lanes from fx_way where highway is not null order by lanes desc nulls first, osm_id desc""")
def order_nulls_first(spark: SparkSession, sf: str) -> DataFrame:
    """``ORDER BY a DESC`` with PostgreSQL's NULLs-first default."""
    w = fx(spark, sf, "fx_way").where("highway IS NOT NULL")
    return w.select("osm_id", "lanes").orderBy(F.col("lanes").desc_nulls_first(), F.col("osm_id").desc())


# ------------------------------------------------------------------ F5 F6 F7
@query("ref_normalise", """
select osm_id, regexp_replace(regexp_replace(upper(ref), '[^0-9A-Z.]', '', 'g'), '^M', 'D') as ref_n,
       regexp_replace(upper(old_ref), '[^0-9A-Z]', '', 'g') as old_ref_n,
       regexp_replace(upper(nat_ref), '[^0-9A-Z]', '', 'g') as nat_ref_n,
       replace(ref, ' ', '') as ref_nospace
from fx_way""")
def ref_normalise(spark: SparkSession, sf: str) -> DataFrame:
    w = inputs.osm_ways(spark, sf)
    return w.select("osm_id", T.normalise_ref("ref").alias("ref_n"),
                    T.normalise_alt_ref(F.element_at("tags", "old_ref")).alias("old_ref_n"),
                    T.normalise_alt_ref(F.element_at("tags", "nat_ref")).alias("nat_ref_n"),
                    T.strip_spaces("ref").alias("ref_nospace"))


@query("ref_pretty", """
select distinct num_route, regexp_replace(num_route, '([A-Z]*)([0-9A-Z]*$)', '\\1 \\2') as pretty from fx_official""")
def ref_pretty(spark: SparkSession, sf: str) -> DataFrame:
    o = inputs.official_vertices(spark, sf).select("num_route").distinct()
    return o.select("num_route", T.pretty_ref("num_route").alias("pretty"))


# ------------------------------------------------------------------ T3 name filter
CADASTRE_NAME = """case when cleabs % 7 = 0 then concat('chemin de ', n) when cleabs % 7 = 1 then concat('Rue ', n)
  when cleabs % 7 = 2 then upper(n) when cleabs % 7 = 3 then concat('sentier dit ', n, ' des bois')
  else concat('allée ', n) end"""
CADASTRE_NAMES_SQL = f"""
select o.cleabs, {CADASTRE_NAME} as nom from (select distinct cleabs from fx_official) o
join (select distinct osm_id, name as n from fx_vertex) v on v.osm_id = o.cleabs"""


def cadastre_names(spark: SparkSession, sf: str) -> DataFrame:
    o = inputs.official_vertices(spark, sf).select("cleabs").distinct()
    v = fx(spark, sf, "fx_vertex").select(F.col("osm_id").alias("cleabs"), F.col("name").alias("n")).distinct()
    return o.join(v, "cleabs").select("cleabs", F.expr(CADASTRE_NAME).alias("nom"))


@query("name_filter", f"""
select cleabs, nom from cad where regexp_matches(nom, '{T.NAME_LETTERS_PATTERN}')
and not regexp_matches(nom, '{T.RURAL_NAME_PATTERN.replace("'", "''")}', 'i')""", (("cad", CADASTRE_NAMES_SQL),))
def name_filter(spark: SparkSession, sf: str) -> DataFrame:
    c = cadastre_names(spark, sf)
    return c.where(F.col("nom").rlike(T.NAME_LETTERS_PATTERN) & ~T.is_rural_name("nom")).select("cleabs", "nom")


# ------------------------------------------------------------------ F1 F3 F10
@query("format_text", """
select osm_id, format('{} ({})', replace(replace(name, '"', ''), '&', '&amp;'), ref) as text from fx_way""")
def format_text(spark: SparkSession, sf: str) -> DataFrame:
    w = fx(spark, sf, "fx_way")
    clean = F.replace(F.replace(F.col("name"), F.lit('"'), F.lit("")), F.lit("&"), F.lit("&amp;"))
    return w.select("osm_id", F.format_string("%s (%s)", clean, F.col("ref")).alias("text"))
