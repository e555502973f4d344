"""Distance checks: C3, C5, C6, C12, C13, C18, C22, C23, C25.

Each check is a library function over feature DataFrames plus a plan that
feeds it the fixtures; the oracle SQL tests every candidate pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoqa.functions import crs
from geoqa.functions import geom as G
from geoqa.functions import lines as LN
from geoqa.functions import text as T
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Box, Point, Polygon
from geoqa.plans import inputs
from geoqa.plans.checks_common import (DEPT_POLY, DEPT_SQL, departments, geohash_col, geohash_sql, line_segments,
                                       lonlat_cols, lonlat_sql, two_stage_pairs, with_midpoint)
from geoqa.plans.fixtures import fx, register
from geoqa.plans.ops_joins import COMMUNE_POLY, SEG_S, _communes_poly, band
from geoqa.plans.ops_relational import CADASTRE_NAMES_SQL, cadastre_names
from geoqa.plans.registry import query
from geoqa.plans.sqlkit import line_ctes

O_CTES = line_ctes("o", "fx_official", "cleabs")


def two_stage_exists_sql(mid: str, line_id: str, way_filter: str, coarse, fine, fine_op: str = "<=",
                         segs: str = "o_seg") -> str:
    """Oracle: some way passing ``way_filter`` is within ``fine`` m of the
    midpoint and its whole line within ``coarse`` of the whole road."""
    geo = SJ.geo_pt_seg_within(f"{mid}.x", f"{mid}.y", SEG_S, str(float(fine)), fine_op)
    near = G.seg_seg_within(("t.x1", "t.y1", "t.x2", "t.y2"), ("s2.x1", "s2.y1", "s2.x2", "s2.y2"), str(float(coarse)))
    return (f"exists (select 1 from fx_segment s join fx_way w on w.osm_id = s.osm_id "
            f"where {way_filter} and {band(f'{mid}.x', f'{mid}.y', SEG_S, round(float(fine) * 1.1 + 1))} and {geo} "
            f"and exists (select 1 from {segs} t join fx_segment s2 on s2.osm_id = s.osm_id "
            f"where t.id = {line_id} and {near}))")


def _ways(spark, sf, cond: str) -> DataFrame:
    return inputs.osm_way_segments(spark, sf).where(cond).select("osm_id", "seg", "x1", "y1", "x2", "y2")


def _lines_with(spark, sf, attr_sql: str) -> DataFrame:
    register(spark, sf)
    return inputs.official_lines(spark, sf).select("cleabs", "pts").join(spark.sql(attr_sql), "cleabs")


# ---------------------------------------------------------------- C5
RTE_SQL = """
select distinct o.cleabs, case when o.cleabs % 4 = 0 then 'EN PROJET' else 'EN EXPLOITATION' end as etat,
       case when o.cleabs % 7 = 0 then 'HORS TENSION' else '63kV' end as tension,
       concat('LIAISON ', upper(v.name), case when o.cleabs % 10 = 1 then ' <2>' else '' end) as nom_ligne
from fx_official o join fx_vertex v on v.osm_id = o.cleabs and v.k = 0"""


def missing_power_line(lines: DataFrame, power_segs: DataFrame, coarse: float = 50.0, fine_m: float = 20.0,
                       min_len_m: float = 50.0) -> DataFrame:
    """7040/95: live power lines longer than ``min_len_m`` with no OSM
    power line near the whole line (``coarse``) and its midpoint (``fine_m``)."""
    live = lines.where((F.col("tension") != "HORS TENSION") & (F.col("etat") == "EN EXPLOITATION")
                       & (F.expr(LN.geo_length("pts")) > min_len_m))
    pairs = two_stage_pairs(live, power_segs, line_id="cleabs", way_id="osm_id", coarse=coarse, fine_m=fine_m)
    lonely = with_midpoint(live.join(pairs.select("cleabs").distinct(), "cleabs", "left_anti"))
    out = lonely.select("mx", "my", F.replace("nom_ligne", F.lit("LIAISON "), F.lit("")).alias("nom")).distinct()
    return out.select(geohash_col("mx", "my"), *lonlat_cols("mx", "my", 7), "nom")


_GEO_LEN = crs.geo_distance(crs.lon_of("x1"), crs.lat_of("y1"), crs.lon_of("x2"), crs.lat_of("y2"))


@query("c05_missing_power_line", f"""
select distinct {geohash_sql('m.x', 'm.y')}, {lonlat_sql('m.x', 'm.y', 7)}, replace(r.nom_ligne, 'LIAISON ', '') as nom
from rte r join o_mid m on m.id = r.cleabs
where r.tension <> 'HORS TENSION' and r.etat = 'EN EXPLOITATION'
and (select sum({_GEO_LEN}) from o_seg g where g.id = r.cleabs) > 50
and not {two_stage_exists_sql('m', 'r.cleabs', "w.power = 'line'", 50, 20)}""", O_CTES + (("rte", RTE_SQL),))
def c05(spark: SparkSession, sf: str) -> DataFrame:
    return missing_power_line(_lines_with(spark, sf, RTE_SQL), _ways(spark, sf, "tags['power'] = 'line'"))


# ---------------------------------------------------------------- C18
BDTOPO_SQL = """
select distinct o.cleabs, o.importance, o.nature, case when o.cleabs % 2 = 0 then v.name else '' end as nom
from fx_official o join fx_vertex v on v.osm_id = o.cleabs and v.k = 0"""


def missing_road(lines: DataFrame, areas: DataFrame, highway_segs: DataFrame, coarse: float = 50.0,
                 fine_m: float = 20.0) -> DataFrame:
    """7170/1 (official roads): important roads (importance < '3', or named
    'Route a...') with the midpoint in an area and no highway near them."""
    sel = lines.where((F.col("importance") < "3") | (F.col("nature").like("Route à%") & (F.col("nom") != "")))
    m = with_midpoint(sel)
    inside = SJ.contains_join(m.select("cleabs", "mx", "my"), areas, ("dept",), point=Point("mx", "my"), polygon=DEPT_POLY)
    sel = sel.join(inside.select("cleabs").distinct(), "cleabs", "left_semi")  # one row per road
    pairs = two_stage_pairs(sel, highway_segs, line_id="cleabs", way_id="osm_id", coarse=coarse, fine_m=fine_m)
    lonely = with_midpoint(sel.join(pairs.select("cleabs").distinct(), "cleabs", "left_anti"))
    return lonely.select("cleabs", *lonlat_cols("mx", "my"))


@query("c18_missing_road", f"""
select b.cleabs, {lonlat_sql('m.x', 'm.y')} from bd b join o_mid m on m.id = b.cleabs
where (b.importance < '3' or b.nature like 'Route à%' and b.nom <> '')
and exists (select 1 from dep d where m.x between d.xmin and d.xmax and m.y between d.ymin and d.ymax)
and not {two_stage_exists_sql('m', 'b.cleabs', 's.highway is not null', 50, 20)}""",
       O_CTES + (("bd", BDTOPO_SQL), ("dep", DEPT_SQL)))
def c18(spark: SparkSession, sf: str) -> DataFrame:
    return missing_road(_lines_with(spark, sf, BDTOPO_SQL), departments(spark, sf),
                        _ways(spark, sf, "highway IS NOT NULL"))


# ---------------------------------------------------------------- C22
WATER_SQL = """
select distinct o.cleabs, case when o.nature like 'Route%' then 'En service' else 'En projet' end as etat,
       case when o.cleabs % 2 = 0 then concat('W', cast(o.cleabs as string)) end as code, v.name as toponyme
from fx_official o join fx_vertex v on v.osm_id = o.cleabs and v.k = 0"""


def missing_waterway(lines: DataFrame, water_segs: DataFrame, coarse: float = 50.0, fine_m: float = 50.0) -> DataFrame:
    """7171/98: streams in service with a code and no OSM waterway near
    them (latitude and longitude reported in their proper columns)."""
    sel = lines.where((F.col("etat") == "En service") & F.col("code").isNotNull())
    pairs = two_stage_pairs(sel, water_segs, line_id="cleabs", way_id="osm_id", coarse=coarse, fine_m=fine_m)
    lonely = with_midpoint(sel.join(pairs.select("cleabs").distinct(), "cleabs", "left_anti"))
    out = lonely.select("mx", "my", F.format_string("%s (%s)", "toponyme", "code").alias("nom")).distinct()
    return out.select(geohash_col("mx", "my"), *lonlat_cols("mx", "my", 7), "nom")


@query("c22_missing_waterway", f"""
select distinct {geohash_sql('m.x', 'm.y')}, {lonlat_sql('m.x', 'm.y', 7)}, format('{{}} ({{}})', r.toponyme, r.code) as nom
from wat r join o_mid m on m.id = r.cleabs
where r.etat = 'En service' and r.code is not null
and not {two_stage_exists_sql('m', 'r.cleabs', 'w.waterway is not null', 50, 50)}""", O_CTES + (("wat", WATER_SQL),))
def c22(spark: SparkSession, sf: str) -> DataFrame:
    return missing_waterway(_lines_with(spark, sf, WATER_SQL), _ways(spark, sf, "tags['waterway'] IS NOT NULL"))


def _counted(df: DataFrame, key: str) -> DataFrame:
    """Adds ``_rows``, how many rows have the key."""
    return df.withColumn("_rows", F.count("*").over(Window.partitionBy(key)))


def _all_left(df: DataFrame, key: str) -> DataFrame:
    """What is left of :func:`_counted` rows, without the keys of which a row has gone."""
    left = df.withColumn("_left", F.count("*").over(Window.partitionBy(key)))
    return left.where("_left = _rows").drop("_left", "_rows")


# ---------------------------------------------------------------- C23
def cadastre_name_without_road(cad: DataFrame, communes: DataFrame, ways: DataFrame, fine_m: float = 50.0,
                               strict_dots: bool = False) -> DataFrame:
    """7170/99: named cadastre lines (three lower-case letters, not a rural
    track) with the midpoint in a commune and no highway whose bbox meets the
    line's bbox and lies within ``fine_m`` m of the midpoint."""
    c = cad.where(F.col("nom").rlike(T.NAME_LETTERS_PATTERN) & ~T.is_rural_name("nom", strict_dots))
    bx = LN.bbox("pts")
    m = with_midpoint(c).select("cleabs", "nom", "mx", "my", *[F.expr(e).alias(n) for e, n in
                                                              zip(bx, ("lx0", "ly0", "lx1", "ly1"))])
    m = SJ.contains_join(m, communes, ("insee",), point=Point("mx", "my"), polygon=COMMUNE_POLY).select(*m.columns)
    m = SJ.with_geo_scales(m, "my")
    h = ways.where("highway IS NOT NULL")
    hs = line_segments(h.where("osm_id IS NOT NULL").select(
        "pts", *[F.expr(e).alias(n) for e, n in zip(bx, ("wx0", "wy0", "wx1", "wy1"))]))
    geo = SJ.geo_pt_seg_within("l.mx", "l.my", ("r.x1", "r.y1", "r.x2", "r.y2"), str(fine_m), scales=SJ.L_SCALES)
    meet = G.box_overlap(("l.lx0", "l.ly0", "l.lx1", "l.ly1"), ("r.wx0", "r.wy0", "r.wx1", "r.wy1"))
    # a line stops at the first way found; the pairs themselves are never rows
    alone = SJ.dwithin_join(_counted(m, "cleabs"), hs, SJ.Ground(fine_m), left_geom=Point("mx", "my"),
                            residual=f"{meet} AND {geo}", how="left_anti")
    lonely = _all_left(alone, "cleabs")
    out = lonely.select("mx", "my", "nom").distinct()
    return out.select(geohash_col("mx", "my"), *lonlat_cols("mx", "my"), "nom")


@query("c23_cadastre_name_without_road", f"""
select distinct {geohash_sql('m.x', 'm.y')}, {lonlat_sql('m.x', 'm.y')}, c.nom
from cad c join o_mid m on m.id = c.cleabs
join (select id, min(least(x1, x2)) as lx0, min(least(y1, y2)) as ly0, max(greatest(x1, x2)) as lx1,
             max(greatest(y1, y2)) as ly1 from o_seg group by id) lb on lb.id = c.cleabs
where regexp_matches(c.nom, '{T.NAME_LETTERS_PATTERN}') and not regexp_matches(c.nom, '{T.RURAL_NAME_PATTERN.replace("'", "''")}', 'i')
and exists (select 1 from fx_commune k where m.x between k.xmin and k.xmax and m.y between k.ymin and k.ymax)
and not exists (
  select 1 from fx_segment s join (select osm_id, min(least(x1, x2)) as wx0, min(least(y1, y2)) as wy0,
                                          max(greatest(x1, x2)) as wx1, max(greatest(y1, y2)) as wy1
                                   from fx_segment group by osm_id) wb on wb.osm_id = s.osm_id
  where s.highway is not null and {band('m.x', 'm.y', SEG_S, 56)}
  and {SJ.geo_pt_seg_within('m.x', 'm.y', SEG_S, '50.0')}
  and lb.lx0 <= wb.wx1 and wb.wx0 <= lb.lx1 and lb.ly0 <= wb.wy1 and wb.wy0 <= lb.ly1)""",
       O_CTES + (("cad", CADASTRE_NAMES_SQL),))
def c23(spark: SparkSession, sf: str) -> DataFrame:
    cad = inputs.official_lines(spark, sf).select("cleabs", "pts").join(cadastre_names(spark, sf), "cleabs")
    ways = inputs.osm_ways(spark, sf).select("osm_id", "highway", "pts")
    return cadastre_name_without_road(cad, _communes_poly(spark, sf), ways)


# ---------------------------------------------------------------- C12
VOIRIE_SQL = "select cleabs as fantoir, x, y from fx_official where k = 0"
FANTOIR_SQL = """
select osm_id as fantoir, 'RUE' as nature_voie, upper(name) as nom_voie,
       case when osm_id % 9 = 0 then 'RURAL' when osm_id % 23 = 0 then null else 'X' end as mot from fx_way"""


def cadastre_street_without_road(centres: DataFrame, register_: DataFrame, way_lines: DataFrame,
                                 areas: DataFrame, dist_m: float = 20.0, line_coarse: float = 100.0,
                                 area_coarse: float = 60.0) -> DataFrame:
    """7170/13: street centres (register word not EXPLOITA/RURAL; a NULL word
    drops the street) with no highway line (< dist_m m, or its centroid
    < dist_m m) and no highway area (< dist_m m)."""
    v = centres.join(register_.where(~F.col("mot").isin(*T.EXCLUDED_WORDS)), "fantoir")
    v = SJ.with_geo_scales(v, "y")
    segs = line_segments(way_lines.select("osm_id", "pts"))
    geo_seg = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), str(dist_m), "<", scales=SJ.L_SCALES)
    # a street stops at the first line, area or centroid found; few streets are left for the later steps
    alone = SJ.dwithin_join(_counted(v, "fantoir"), segs.select("x1", "y1", "x2", "y2"), SJ.Ground(dist_m, planar=line_coarse),
                            residual=geo_seg, how="left_anti")
    geo_area = (f"({G.pt_in_polygon('l.x', 'l.y', 'r.rings')} OR {SJ.geo_pt_rings_d('l.x', 'l.y', 'r.rings', scales=SJ.L_SCALES)} < {dist_m})")
    areas = areas.where("highway IS NOT NULL").select("rings", "xmin", "ymin", "xmax", "ymax")
    alone = SJ.dwithin_join(alone, areas, SJ.Ground(dist_m, ("ymin", "ymax"), planar=area_coarse),
                            right_geom=Polygon("rings", ("xmin", "ymin", "xmax", "ymax")), residual=geo_area, how="left_anti")
    cen = way_lines.select(F.expr(LN.centroid("pts")).alias("c"), F.expr(LN.line_to_segments("pts")).alias("segs")).select(
        F.col("c.x").alias("gx"), F.col("c.y").alias("gy"), "segs")
    geo_cen = SJ.geo_pt_pt_within("l.x", "l.y", "r.gx", "r.gy", str(dist_m), "<", scales=SJ.L_SCALES)
    near_line = f"exists(r.segs, s -> {G.pt_seg_within('l.x', 'l.y', 's.x1', 's.y1', 's.x2', 's.y2', str(line_coarse))})"
    alone = SJ.dwithin_join(alone, cen, SJ.Ground(dist_m, ("gy",)), right_geom=Point("gx", "gy"),
                            residual=f"{geo_cen} AND {near_line}", how="left_anti")
    lonely = _all_left(alone, "fantoir")
    out = lonely.select(F.round(F.expr(crs.lat_of("y")), 5).alias("lat"), F.round(F.expr(crs.lon_of("x")), 5).alias("lon"),
                        "fantoir", F.trim(F.format_string("%s %s", "nature_voie", "nom_voie")).alias("nom"))
    return out.distinct()


_C12_LINE = SJ.geo_pt_seg_within("v.x", "v.y", SEG_S, "20.0", "<")
_C12_CEN = SJ.geo_pt_pt_within("v.x", "v.y", "g.gx", "g.gy", "20.0", "<")
# the edges of the areas near a street centre, moved to the centre and scaled to metres there
_C12_EDGE = f"""
select v.fantoir, e.osm_id, (e.x1 - v.x) * {crs.scale_e('v.y')} as x1, (e.y1 - v.y) * {crs.scale_n('v.y')} as y1,
       (e.x2 - v.x) * {crs.scale_e('v.y')} as x2, (e.y2 - v.y) * {crs.scale_n('v.y')} as y2
from vo v join hb b on v.x between b.bx0 - 25 and b.bx1 + 25 and v.y between b.by0 - 25 and b.by1 + 25
join fx_building a on a.osm_id = b.osm_id and a.highway is not null join fx_house_e e on e.osm_id = b.osm_id"""


@query("c12_cadastre_street_without_road", f"""
select distinct round({crs.lat_of('v.y')}, 5) as lat, round({crs.lon_of('v.x')}, 5) as lon, v.fantoir,
       trim(format('{{}} {{}}', f.nature_voie, f.nom_voie)) as nom
from vo v join fa f on f.fantoir = v.fantoir and f.mot not in ('EXPLOITA', 'RURAL')
where not exists (select 1 from fx_segment s where s.highway is not null and {band('v.x', 'v.y', SEG_S, 25)} and {_C12_LINE})
and not exists (select 1 from g_cen g where g.highway is not null
                and g.gx between v.x - 25 and v.x + 25 and g.gy between v.y - 25 and v.y + 25 and {_C12_CEN}
                and exists (select 1 from fx_segment s where s.osm_id = g.osm_id and {G.pt_seg_within('v.x', 'v.y', *SEG_S, '100.0')}))
and v.fantoir not in (select fantoir from ae where {inputs.clamp_d2_sql('0.0', '0.0', 'ae')} < 400.0)
and not exists (select 1 from hb b join fx_building a on a.osm_id = b.osm_id and a.highway is not null
                where v.x between b.bx0 and b.bx1 and v.y between b.by0 and b.by1
                and {inputs.in_house_sql('v.x', 'v.y', 'b.osm_id')})""",
       inputs.HOUSE_CTES + (("vo", VOIRIE_SQL), ("fa", FANTOIR_SQL), ("ae", _C12_EDGE), ("g_cen", """
select s.osm_id, max(s.highway) as highway, sum(len * (x1 + x2) / 2) / sum(len) as gx, sum(len * (y1 + y2) / 2) / sum(len) as gy
from (select *, sqrt(cast((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) as double)) as len from fx_segment) s group by s.osm_id""")))
def c12(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    ways = inputs.osm_ways(spark, sf).where("highway IS NOT NULL").select("osm_id", "pts")
    areas = inputs.house_footprints(spark, sf)
    return cadastre_street_without_road(spark.sql(VOIRIE_SQL), spark.sql(FANTOIR_SQL), ways, areas)


# ---------------------------------------------------------------- C25
HIKE_SQL = "select cleabs, k, x, y from fx_official where itineraire is not null"


def missing_path_vertex(vertices: DataFrame, highway_segs: DataFrame, planar: float = 200.0, fine_m: float = 25.0) -> DataFrame:
    """7170/98: distinct route vertices with no highway within ``planar``
    units and ``fine_m`` ground metres."""
    v = SJ.with_geo_scales(vertices, "y")
    geo = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), str(fine_m), scales=SJ.L_SCALES)
    lonely = SJ.dwithin_join(v, highway_segs, SJ.Ground(fine_m, planar=planar),
                             residual=f"{G.pt_seg_within('l.x', 'l.y', 'r.x1', 'r.y1', 'r.x2', 'r.y2', str(planar))} AND {geo}",
                             how="left_anti")
    out = lonely.select("x", "y").distinct()
    return out.select(geohash_col("x", "y"), *lonlat_cols("x", "y", 7))


@query("c25_missing_path_vertex", f"""
select distinct {geohash_sql('v.x', 'v.y')}, {lonlat_sql('v.x', 'v.y', 7)} from hk v
where not exists (select 1 from fx_segment s where s.highway is not null and {band('v.x', 'v.y', SEG_S, 30)}
                  and {G.pt_seg_within('v.x', 'v.y', *SEG_S, '200.0')} and {SJ.geo_pt_seg_within('v.x', 'v.y', SEG_S, '25.0')})""",
       (("hk", HIKE_SQL),))
def c25(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    return missing_path_vertex(spark.sql(HIKE_SQL), _ways(spark, sf, "highway IS NOT NULL"))


# ---------------------------------------------------------------- C3
def poi_near_building(pois: DataFrame, communes: DataFrame, buildings: DataFrame, dist: float = 20.0) -> DataFrame:
    """7170/60: shops in a commune, outside every building, but within
    ``dist`` of one; reports the smallest ground distance (m, 2 decimals)."""
    p = pois.where(F.col("shop").isNotNull() & ~F.col("shop").isin(*T.EXCLUDED_SHOPS))
    p = SJ.contains_join(p, communes, ("insee",), polygon=COMMUNE_POLY).select(*p.columns).distinct()
    b = buildings.select("rings", "xmin", "ymin", "xmax", "ymax")
    shape = Polygon("rings", ("xmin", "ymin", "xmax", "ymax"))
    p = SJ.dwithin_join(p, b, 0, right_geom=shape, how="left_anti")
    near = SJ.with_geo_scales(SJ.dwithin_join(p, b, dist, right_geom=shape), "y")
    d = F.expr(SJ.geo_pt_rings_d("x", "y", "rings", scales=("_sx", "_sy")))
    g = near.groupBy("osm_id", "x", "y", "shop").agg(F.round(F.min(d), 2).alias("dist_m"))
    return g.select("osm_id", "shop", "dist_m", *lonlat_cols("x", "y"))


# the edges near a shop, moved to the shop and scaled to metres there
_C3_EDGE = f"""
select p.osm_id as poi, e.osm_id, {inputs.clamp_d2_sql('p.x', 'p.y', 'e')} as d2, (e.x1 - p.x) * {crs.scale_e('p.y')} as x1, (e.y1 - p.y) * {crs.scale_n('p.y')} as y1,
       (e.x2 - p.x) * {crs.scale_e('p.y')} as x2, (e.y2 - p.y) * {crs.scale_n('p.y')} as y2
from fx_poi p join hb b on p.x between b.bx0 - 21 and b.bx1 + 21 and p.y between b.by0 - 21 and b.by1 + 21
join fx_house_e e on e.osm_id = b.osm_id"""


@query("c03_poi_near_building", f"""
select p.osm_id, p.shop, round(min(b.d), 2) as dist_m, {lonlat_sql('p.x', 'p.y')}
from fx_poi p join (select m.poi, m.osm_id, min(m.d2) as d2, min(sqrt({inputs.clamp_d2_sql('0.0', '0.0', 'm')})) as d from pe m group by m.poi, m.osm_id) b
  on b.poi = p.osm_id and b.d2 <= 400
where p.shop is not null and p.shop not in ('car', 'car_repair', 'kiosk')
and exists (select 1 from fx_commune c where p.x between c.xmin and c.xmax and p.y between c.ymin and c.ymax)
and not exists (select 1 from hb b2 where p.x between b2.bx0 and b2.bx1 and p.y between b2.by0 and b2.by1 and {inputs.in_house_sql('p.x', 'p.y', 'b2.osm_id')})
group by p.osm_id, p.x, p.y, p.shop""", inputs.HOUSE_CTES + (("pe", _C3_EDGE),))
def c03(spark: SparkSession, sf: str) -> DataFrame:
    pois = fx(spark, sf, "fx_poi").select("osm_id", "x", "y", "shop")
    return poi_near_building(pois, _communes_poly(spark, sf), inputs.house_footprints(spark, sf))


# ---------------------------------------------------------------- C6
BLD_TAGS_SQL = """
select osm_id, 'yes' as building, case when osm_id % 6 = 0 then 'substation' end as power,
       case when osm_id % 12 = 0 then 'minor_distribution' end as substation,
       case when osm_id % 25 = 0 then 'no' end as wall from fx_building"""


# stations: the shops' places, and one inside every third building
STATION_SQL = """
select osm_id as id, x, y, 'Enedis' as operator from fx_poi
union all select 10000000 + osm_id as id, x0 + 4 as x, y0 + 2 as y, 'Enedis' as operator from fx_building where osm_id % 3 = 0"""


def substation_to_import(stations: DataFrame, communes: DataFrame, buildings: DataFrame, way_segs: DataFrame,
                         area_max: float = 50.0, near: float = 50.0) -> DataFrame:
    """8280/94: distribution stations inside a small, not yet tagged
    building; the suggested fix depends on an underground line within
    ``near`` (flag, no row multiplication) and on the ground area."""
    s = SJ.contains_join(stations, communes, ("insee",), polygon=COMMUNE_POLY).select(*stations.columns).distinct()
    b = buildings.where(F.col("building").isNotNull() & (F.coalesce("wall", F.lit("")) != "no")
                        & (F.col("power").isNull() | (F.col("power") != "substation")
                           | (F.col("substation") != "minor_distribution"))
                        & (F.expr(LN.area("rings")) < area_max))
    shapes = b.select(F.col("osm_id").alias("bid"), F.col("rings").alias("footprint"))
    sb = SJ.contains_join(s, shapes, ("bid",), polygon=Polygon("footprint")).join(shapes, "bid")
    underground = way_segs.where("tags['location'] = 'underground'").select("x1", "y1", "x2", "y2")
    flag = SJ.dwithin_join(s, underground, near, how="left_semi").select("id", F.lit(True).alias("underground"))
    sb = sb.join(flag, "id", "left")
    sb = sb.withColumn("c", F.expr(LN.polygon_centroid("footprint")))
    m2 = F.rint(F.expr(f"{LN.area('footprint')} * {crs.scale_e('c.y')} * {crs.scale_n('c.y')}")).cast("bigint")
    sb = sb.withColumn("m2", m2)
    fix = (F.when(F.col("underground").isNull(), "transformer_tower")
            .when(F.col("m2") < 4, "street_cabinet").otherwise("building_service"))
    out = sb.select(F.col("bid").alias("osm_id"), "id", "operator", "m2", "underground", fix.alias("fix"),
                    *lonlat_cols("x", "y"))
    return out.distinct()


@query("c06_substation_to_import", f"""
select distinct b.osm_id, p.id, p.operator, cast(round_even(hs.area * {crs.scale_e('hs.gy')} * {crs.scale_n('hs.gy')}, 0) as bigint) as m2,
       u.flag as underground,
       case when u.flag is null then 'transformer_tower'
            when round_even(hs.area * {crs.scale_e('hs.gy')} * {crs.scale_n('hs.gy')}, 0) < 4 then 'street_cabinet'
            else 'building_service' end as fix,
       {lonlat_sql('p.x', 'p.y')}
from st p join hb b on p.x between b.bx0 and b.bx1 and p.y between b.by0 and b.by1 and {inputs.in_house_sql('p.x', 'p.y', 'b.osm_id')}
join hs on hs.osm_id = b.osm_id
join bt t on t.osm_id = b.osm_id
left join (select distinct p2.id, true as flag from st p2 join fx_segment s on {G.pt_seg_within('p2.x', 'p2.y', *SEG_S, '50')}
           join fx_way w on w.osm_id = s.osm_id where w.location = 'underground') u on u.id = p.id
where t.building is not null and coalesce(t.wall, '') <> 'no'
and (t.power is null or t.power <> 'substation' or t.substation <> 'minor_distribution') and hs.area < 50
and exists (select 1 from fx_commune c where p.x between c.xmin and c.xmax and p.y between c.ymin and c.ymax)""",
       inputs.HOUSE_CTES + (("st", STATION_SQL), ("bt", BLD_TAGS_SQL)))
def c06(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    st = spark.sql(STATION_SQL)
    b = inputs.house_footprints(spark, sf).drop("building").join(spark.sql(BLD_TAGS_SQL), "osm_id")
    return substation_to_import(st, _communes_poly(spark, sf), b, inputs.osm_way_segments(spark, sf))


# ---------------------------------------------------------------- C13
def unimported_buildings(squares: DataFrame, communes: DataFrame, size: float = 500.0) -> DataFrame:
    """7170/50: communes with a vector cadastre where the squares with no
    building outnumber half (integer division) of all squares they cover."""
    communes = communes.where("cadastre = 'VECT'")
    # the communes cut at the squares' own borders: a square is covered if its piece is full, or no edge runs
    # through its inside (edges on its border do not) and its reference point lies in the commune
    pieces = SJ.polygon_pieces(communes.select("insee", "rings"), ["insee"], cell=size).alias("r")
    inner = (f"(q.cx * {size} + 1e-9)", f"(q.cy * {size} + 1e-9)", f"((q.cx + 1) * {size} - 1e-9)", f"((q.cy + 1) * {size} - 1e-9)")
    whole = f"(r._full OR (r._in AND NOT exists(r._edges, e -> {G.seg_intersects_box(('e.x1', 'e.y1', 'e.x2', 'e.y2'), inner)})))"
    q = squares.select("cx", "cy", "buildings").alias("q")
    j = q.join(pieces, (F.col("q.cx") == F.col("r._cx")) & (F.col("q.cy") == F.col("r._cy")) & F.expr(whole))
    agg = j.groupBy("insee").agg(F.sum(F.when(F.col("buildings") == 0, 1).otherwise(0)).alias("nb"), F.count("*").alias("total"))
    agg = agg.where((F.col("nb") > 0) & (F.col("nb") > F.floor(F.col("total") / 2)))
    pos = agg.join(communes.select("insee", "osm_id", "name", "rings"), "insee").withColumn("p", F.expr(LN.point_on_surface("rings")))
    return pos.select((-F.col("osm_id")).alias("relation"), "insee", "name", F.col("nb").cast("bigint").alias("nb"),
                      "total", *lonlat_cols("p.x", "p.y"))


@query("c13_unimported_buildings", f"""
select -(c.insee + 1000) as relation, c.insee, n.n_name as name, cast(m.nb as bigint) as nb, m.total,
       {lonlat_sql('(c.xmin + c.xmax) / 2.0', '(c.ymin + c.ymax) / 2.0')}
from (select c.insee, sum(case when q.buildings = 0 then 1 else 0 end) as nb, count(*) as total
      from fx_square q join fx_commune c on q.cx * 500 >= c.xmin and q.cx * 500 + 500 <= c.xmax
                                      and q.cy * 500 >= c.ymin and q.cy * 500 + 500 <= c.ymax
      where c.cadastre = 'VECT' group by c.insee) m
join fx_commune c on c.insee = m.insee join nation n on n.n_nationkey = c.insee
where m.nb > 0 and m.nb > cast(floor(m.total / 2) as bigint)""")
def c13(spark: SparkSession, sf: str) -> DataFrame:
    c = inputs.communes(spark, sf).select("insee", "cadastre", "rings")
    nat = fx(spark, sf, "nation").select(F.col("n_nationkey").alias("insee"), F.col("n_name").alias("name"))
    c = c.join(nat, "insee").withColumn("osm_id", F.col("insee") + 1000)
    return unimported_buildings(fx(spark, sf, "fx_square"), c)
