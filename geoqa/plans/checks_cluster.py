"""Checks that report clusters of unmatched features: C8, C10, C11, C24."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import crs
from geoqa.functions import geom as G
from geoqa.functions import lines as LN
from geoqa.operators import cluster as CL
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Box, Point, Polygon
from geoqa.plans import inputs
from geoqa.plans.checks_common import geohash_col, geohash_sql, lonlat_cols, lonlat_sql
from geoqa.plans.checks_dist import HIKE_SQL, O_CTES
from geoqa.plans.checks_shift import OFFICIAL_COMMUNE_SQL, _BND_SEG
from geoqa.plans.fixtures import fx, register
from geoqa.plans.ops_cluster import components_ctes
from geoqa.plans.ops_joins import COMMUNE_POLY, SEG_S, _communes_poly, band
from geoqa.plans.registry import query
from geoqa.session import ensure_checkpoint_dir


def geo_seg_rings_within(rings: str, seg: tuple, metres, centre: tuple, scales: tuple) -> str:
    """Ground distance polygon-segment <= metres, in the local metric at ``centre``."""
    sc = lambda p: tuple(f"((({v}) - {c}) * {s})" for v, c, s in zip(p, centre * 2, scales * 2))
    near = G.seg_seg_within(sc(("e.x1", "e.y1", "e.x2", "e.y2")), sc(seg), str(metres))
    return f"({G.pt_in_polygon(seg[0], seg[1], rings)} OR exists({SJ._edges(rings)}, e -> {near}))"


# ---------------------------------------------------------------- C10
def address_without_road(addresses: DataFrame, communes: DataFrame, highway_segs: DataFrame,
                         planar: float = 600.0, fine_m: float = 200.0, cluster_d: float = 1000.0) -> DataFrame:
    """7170/12: addresses in a commune with no highway within ``planar``
    units and closer than ``fine_m`` m, clustered at ``cluster_d`` per
    department; one row per cluster at its centroid (mean lon/lat)."""
    a = SJ.contains_join(addresses, communes, ("insee",), polygon=COMMUNE_POLY).select(
        "id", "x", "y", "dept")
    a = SJ.with_geo_scales(a, "y")
    geo = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), str(fine_m), "<", scales=SJ.L_SCALES)
    planar_t = G.pt_seg_within("l.x", "l.y", "r.x1", "r.y1", "r.x2", "r.y2", str(planar))
    lonely = SJ.dwithin_join(a, highway_segs, SJ.Ground(fine_m, planar=planar),
                             residual=f"{planar_t} AND {geo}", how="left_anti")
    c = CL.cluster_within(lonely, cluster_d, group_by=("dept",))
    c = c.withColumn("lon", F.expr(crs.lon_of("x"))).withColumn("lat", F.expr(crs.lat_of("y")))
    m = c.groupBy("dept", "cluster_id").agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count("*").alias("n"))
    return m.select("dept", "cluster_id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"), "n")


_C10_LONELY = f"""
select a.id, a.x, a.y, c.dept from fx_address a join fx_commune c on a.x between c.xmin and c.xmax and a.y between c.ymin and c.ymax
where not exists (select 1 from fx_segment s where s.highway is not null and {band('a.x', 'a.y', SEG_S, 210)}
                  and {G.pt_seg_within('a.x', 'a.y', *SEG_S, '600.0')} and {SJ.geo_pt_seg_within('a.x', 'a.y', SEG_S, '200.0', '<')})"""


@query("c10_address_without_road", f"""
select l.g as dept, l.label as cluster_id, round(avg({crs.lon_of('p.x')}), 7) as lon, round(avg({crs.lat_of('p.y')}), 7) as lat,
       count(*) as n
from cc_lab l join lonely p on p.id = l.id and p.dept = l.g group by l.g, l.label""",
       (("lonely", _C10_LONELY),) + components_ctes("lonely", 1000, group="dept"))
def c10(spark: SparkSession, sf: str) -> DataFrame:
    a = inputs.addresses(spark, sf).select("id", "x", "y")
    c = inputs.communes(spark, sf).select("insee", "dept", "rings", F.col("xmin").alias("cxmin"),
                                          F.col("ymin").alias("cymin"), F.col("xmax").alias("cxmax"),
                                          F.col("ymax").alias("cymax"))
    return address_without_road(a, c, inputs.highways(spark, sf).select("x1", "y1", "x2", "y2"))


# ---------------------------------------------------------------- C11
def building_cluster_without_road(buildings: DataFrame, communes: DataFrame, highway_segs: DataFrame,
                                  min_area: float = 90.0, fine_m: float = 200.0, coarse: float = 600.0,
                                  cluster_d: float = 600.0) -> DataFrame:
    """7170/11 (clusters): footprints larger than ``min_area`` meeting a
    commune, with no highway within ``fine_m`` m (and the bbox within
    ``coarse``), clustered at ``cluster_d`` per department; one row per
    cluster at its area-weighted centroid."""
    shape, box = Polygon("rings", ("xmin", "ymin", "xmax", "ymax")), ("xmin", "ymin", "xmax", "ymax")
    b = buildings.withColumn("a", F.expr(LN.area("rings"))).where(F.col("a") > min_area)
    b = b.withColumn("_c0", F.expr(LN.polygon_centroid("rings"))).select("osm_id", "rings", *box, "a", F.col("_c0.x").alias("cx"), F.col("_c0.y").alias("cy"))
    j = SJ.polygons_intersect_join(b.select("osm_id", "rings"), communes.select("insee", "dept", "rings"), left_key=("osm_id",), right_key=("insee",))
    j = b.join(j.select("osm_id", "insee", "dept"), "osm_id").select(*b.columns, "insee", "dept")
    j = SJ.with_geo_scales(j, "cy").withColumn("_k", F.struct("osm_id", "insee"))
    geo = geo_seg_rings_within("l.rings", ("r.x1", "r.y1", "r.x2", "r.y2"), fine_m, ("l.cx", "l.cy"), SJ.L_SCALES)
    # the metric is that of the centroid: the radius leaves room for the footprint's extent
    lonely = SJ.dwithin_join(j, highway_segs, SJ.Ground(fine_m, planar=coarse, slack=0.01), left_geom=shape, residual=geo, how="left_anti",
                             left_key="_k")
    v = lonely.withColumn("vx", F.expr("rings[0][0].x")).withColumn("vy", F.expr("rings[0][0].y"))
    c = CL.cluster_within(v, cluster_d, id_col="osm_id", x="vx", y="vy", group_by=("dept",), box=box, rings="rings")
    m = c.groupBy("dept", "cluster_id").agg((F.sum(F.col("a") * F.col("cx")) / F.sum("a")).alias("mx"),
                                            (F.sum(F.col("a") * F.col("cy")) / F.sum("a")).alias("my"),
                                            F.count("*").alias("n"))
    return m.select("dept", "cluster_id", *lonlat_cols("mx", "my", 7), "n")


# house edges and roads near each other, moved to the house's centroid and scaled to metres there
_C11_NEAR = f"""
select hs.osm_id, (e.x1 - hs.gx) * {crs.scale_e('hs.gy')} as ex1, (e.y1 - hs.gy) * {crs.scale_n('hs.gy')} as ey1,
       (e.x2 - hs.gx) * {crs.scale_e('hs.gy')} as ex2, (e.y2 - hs.gy) * {crs.scale_n('hs.gy')} as ey2,
       (s.x1 - hs.gx) * {crs.scale_e('hs.gy')} as sx1, (s.y1 - hs.gy) * {crs.scale_n('hs.gy')} as sy1,
       (s.x2 - hs.gx) * {crs.scale_e('hs.gy')} as sx2, (s.y2 - hs.gy) * {crs.scale_n('hs.gy')} as sy2
from hs join hb b on b.osm_id = hs.osm_id
join fx_segment s on s.highway is not null and least(s.x1, s.x2) <= b.bx1 + 210 and b.bx0 - 210 <= greatest(s.x1, s.x2)
  and least(s.y1, s.y2) <= b.by1 + 210 and b.by0 - 210 <= greatest(s.y1, s.y2)
join fx_house_e e on e.osm_id = hs.osm_id where hs.area > 90"""
_C11_ROWS = """
select osm_id, struct_pack(x1 := ex1, y1 := ey1, x2 := ex2, y2 := ey2) as e, struct_pack(x1 := sx1, y1 := sy1, x2 := sx2, y2 := sy2) as s from n0"""
_C11_CROSS = """((s.x2 - s.x1) * (e.y1 - s.y1) - (s.y2 - s.y1) * (e.x1 - s.x1)) * ((s.x2 - s.x1) * (e.y2 - s.y1) - (s.y2 - s.y1) * (e.x2 - s.x1)) < 0
  and ((e.x2 - e.x1) * (s.y1 - e.y1) - (e.y2 - e.y1) * (s.x1 - e.x1)) * ((e.x2 - e.x1) * (s.y2 - e.y1) - (e.y2 - e.y1) * (s.x2 - e.x1)) < 0"""
_C11_ROAD = f"""
select distinct osm_id from n1 where least({inputs.clamp_d2_sql('s.x1', 's.y1', 'e')}, {inputs.clamp_d2_sql('s.x2', 's.y2', 'e')},
  {inputs.clamp_d2_sql('e.x1', 'e.y1', 's')}, {inputs.clamp_d2_sql('e.x2', 'e.y2', 's')}) <= 40000.0 or ({_C11_CROSS})"""
_C11_LONELY = f"""
select hs.osm_id as id, hb.bx0 as x, hb.by0 as y, hs.gx, hs.gy, hs.area, c.dept
from hs join hb on hb.osm_id = hs.osm_id
join fx_commune c on hb.bx0 <= c.xmax and c.xmin <= hb.bx1 and hb.by0 <= c.ymax and c.ymin <= hb.by1
where hs.area > 90 and hs.osm_id not in (select osm_id from road)
  and (exists (select 1 from fx_house_e e where e.osm_id = hs.osm_id and {G.seg_intersects_box(('e.x1', 'e.y1', 'e.x2', 'e.y2'), ('c.xmin', 'c.ymin', 'c.xmax', 'c.ymax'))}))"""
_C11_PAIR = f"""exists (select 1 from fx_house_e e, fx_house_e s where e.osm_id = a.id and s.osm_id = b.id and least(
  {inputs.clamp_d2_sql('s.x1', 's.y1', 'e')}, {inputs.clamp_d2_sql('s.x2', 's.y2', 'e')}, {inputs.clamp_d2_sql('e.x1', 'e.y1', 's')},
  {inputs.clamp_d2_sql('e.x2', 'e.y2', 's')}) <= 360000.0)"""


@query("c11_building_cluster_without_road", f"""
select l.g as dept, l.label as cluster_id, {lonlat_sql('sum(p.area * p.gx) / sum(p.area)', 'sum(p.area * p.gy) / sum(p.area)', 7)}, count(*) as n
from cc_lab l join lonely p on p.id = l.id and p.dept = l.g group by l.g, l.label""",
       inputs.HOUSE_CTES + (("n0", _C11_NEAR), ("n1", _C11_ROWS), ("road", _C11_ROAD), ("lonely", _C11_LONELY))
       + components_ctes("lonely", 600, group="dept", pair=_C11_PAIR, band=700))
def c11(spark: SparkSession, sf: str) -> DataFrame:
    b = inputs.house_footprints(spark, sf)
    c = _communes_poly(spark, sf).join(inputs.communes(spark, sf).select("insee", "dept"), "insee")
    return building_cluster_without_road(b, c, inputs.highways(spark, sf).select("x1", "y1", "x2", "y2"))


# ---------------------------------------------------------------- C24
def missing_hiking_route(routes: DataFrame, hiking_segs: DataFrame, planar: float = 200.0, fine_m: float = 25.0,
                         cluster_d: float = 200.0) -> DataFrame:
    """7170/95: vertices of planned routes with no OSM hiking route within
    ``planar`` units and ``fine_m`` m, clustered at ``cluster_d`` per route,
    each cluster snapped back onto its route."""
    v = routes.select("cleabs", "nom", F.posexplode("pts").alias("k", "p")).select(
        "cleabs", "nom", "k", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    v = SJ.with_geo_scales(v, "y")
    geo = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), str(fine_m), scales=SJ.L_SCALES)
    planar_t = G.pt_seg_within("l.x", "l.y", "r.x1", "r.y1", "r.x2", "r.y2", str(planar))
    lonely = SJ.dwithin_join(v, hiking_segs, SJ.Ground(fine_m, planar=planar),
                             residual=f"{planar_t} AND {geo}", how="left_anti")
    c = CL.cluster_within(lonely, cluster_d, id_col="k", group_by=("cleabs",))
    m = CL.cluster_centroid(c, keys=("cleabs",))
    snap = (m.join(routes.select("cleabs", "nom", "pts"), "cleabs")
             .withColumn("p", F.expr(LN.closest_point("pts", "cx", "cy"))))
    return snap.select("cleabs", "cluster_id", "nom", geohash_col("p.x", "p.y"), *lonlat_cols("p.x", "p.y", 7))


_C24_LONELY = f"""
select v.cleabs as r, v.k as id, v.x, v.y from hk v
where not exists (select 1 from fx_segment s join fx_way w on w.osm_id = s.osm_id where w.route = 'hiking'
                  and {band('v.x', 'v.y', SEG_S, 30)} and {G.pt_seg_within('v.x', 'v.y', *SEG_S, '200.0')}
                  and {SJ.geo_pt_seg_within('v.x', 'v.y', SEG_S, '25.0')})"""
_C24_CENT = "select l.g as r, l.label as cl, avg(p.x) as cx, avg(p.y) as cy from cc_lab l join lonely p on p.r = l.g and p.id = l.id group by l.g, l.label"
_C24_T = ("case when (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) = 0 or (cx-x1)*(x2-x1)+(cy-y1)*(y2-y1) <= 0 then 0.0 "
          "when (cx-x1)*(x2-x1)+(cy-y1)*(y2-y1) >= (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) then 1.0 "
          "else cast((cx-x1)*(x2-x1)+(cy-y1)*(y2-y1) as double) / ((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) end")


@query("c24_missing_hiking_route", f"""
select r as cleabs, cast(cl as bigint) as cluster_id, nom, {geohash_sql('px', 'py')}, {lonlat_sql('px', 'py', 7)} from (
  select q.*, row_number() over (partition by r, cl order by (px - cx) * (px - cx) + (py - cy) * (py - cy), seg) as rn from (
    select c.r, c.cl, c.cx, c.cy, s.seg, n.nom,
           cast(s.x1 + (s.x2 - s.x1) * ({_C24_T}) as double) as px, cast(s.y1 + (s.y2 - s.y1) * ({_C24_T}) as double) as py
    from cent c join o_seg s on s.id = c.r join hnom n on n.cleabs = c.r) q) z
where rn = 1""",
       O_CTES + (("hk", HIKE_SQL), ("lonely", _C24_LONELY)) + components_ctes("lonely", 200, group="r")
       + (("cent", _C24_CENT), ("hnom", "select distinct o.cleabs, concat('Sentier ', v.name) as nom from fx_official o join fx_vertex v on v.osm_id = o.cleabs and v.k = 0")))
def c24(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    routes = (inputs.official_lines(spark, sf).where("itineraire IS NOT NULL").select("cleabs", "pts")
              .join(fx(spark, sf, "fx_vertex").where("k = 0").select(
                  F.col("osm_id").alias("cleabs"), F.concat(F.lit("Sentier "), "name").alias("nom")), "cleabs"))
    hk = inputs.osm_way_segments(spark, sf).where("tags['route'] = 'hiking'").select("x1", "y1", "x2", "y2")
    return missing_hiking_route(routes, hk)


# ---------------------------------------------------------------- C8
def shifted_boundary_clusters(official_pts: DataFrame, osm_boundaries: DataFrame, min_m: float = 25.0,
                              cluster_d: float = 300.0) -> DataFrame:
    """7170/40 (cadastre): official outline vertices more than ``min_m`` m
    from the OSM boundary of their commune, clustered at ``cluster_d`` per
    commune; one row per cluster (centroid) carrying the commune's largest
    offset."""
    v = SJ.with_geo_scales(official_pts, "y")
    geo = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), str(min_m), scales=SJ.L_SCALES)
    far = SJ.dwithin_join(v, osm_boundaries.withColumnRenamed("insee", "b_insee"), SJ.Ground(min_m),
                          residual=f"l.insee = r.b_insee AND {geo}", how="left_anti")
    ensure_checkpoint_dir(far.sparkSession)
    far = far.checkpoint()  # measured and clustered
    dist = SJ.nearest_join(far, osm_boundaries.withColumnRenamed("insee", "b_insee"), key=("insee", "vid"), by=(("insee", "b_insee"),),
                           start=4 * min_m, distance=SJ.geo_pt_seg_d("x", "y", ("x1", "y1", "x2", "y2"), scales=("_sx", "_sy")), scale="least(_sx, _sy)")
    worst = dist.groupBy("insee").agg(F.max("d").alias("dmax"))
    c = CL.cluster_within(far, cluster_d, id_col="vid", group_by=("insee",))
    m = CL.cluster_centroid(c, keys=("insee", "nom"))
    m = m.join(worst, "insee")
    return m.select("insee", "cluster_id", *lonlat_cols("cx", "cy"), F.round("dmax", 1).alias("dist_m"),
                    F.format_string("%s (%s)", "nom", F.col("insee").cast("string")).alias("text"))


_C8_PTS = """
select insee, nom, t * 4 + 0 as vid, xmin + t * 250 as x, ymin as y from offc cross join range(0, 17) r(t)
union all select insee, nom, t * 4 + 1, xmax, ymin + t * 250 from offc cross join range(0, 17) r(t)
union all select insee, nom, t * 4 + 2, xmax - t * 250, ymax from offc cross join range(0, 17) r(t)
union all select insee, nom, t * 4 + 3, xmin, ymax - t * 250 from offc cross join range(0, 17) r(t)"""
_C8_D = SJ.geo_pt_seg_d("v.x", "v.y", ("b.x1", "b.y1", "b.x2", "b.y2"))


@query("c08_shifted_boundary_clusters", f"""
select c.insee, c.label as cluster_id, {lonlat_sql('c.cx', 'c.cy')}, round(w.dmax, 1) as dist_m,
       format('{{}} ({{}})', c.nom, c.insee) as text
from (select l.g as insee, max(p.nom) as nom, l.label, avg(p.x) as cx, avg(p.y) as cy
      from cc_lab l join far p on p.insee = l.g and p.id = l.id group by l.g, l.label) c
join (select insee, max(d) as dmax from far group by insee) w on w.insee = c.insee""",
       (("offc", OFFICIAL_COMMUNE_SQL), ("bnd", _BND_SEG), ("pts", _C8_PTS), ("far", f"""
select insee, nom, vid as id, x, y, d from (
  select v.insee, v.nom, v.vid, v.x, v.y, min({_C8_D}) as d from pts v join bnd b on b.insee = v.insee
  group by v.insee, v.nom, v.vid, v.x, v.y) z where d > 25""")) + components_ctes("far", 300, group="insee"))
def c08(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    off = spark.sql(OFFICIAL_COMMUNE_SQL)
    t = F.explode(F.sequence(F.lit(0), F.lit(16))).alias("t")
    base = off.select("insee", "nom", "xmin", "ymin", "xmax", "ymax", t)
    pts = base.select("insee", "nom", F.explode(F.array(
        F.struct((F.col("t") * 4).alias("vid"), (F.col("xmin") + F.col("t") * 250).alias("x"), F.col("ymin").alias("y")),
        F.struct((F.col("t") * 4 + 1).alias("vid"), F.col("xmax").alias("x"), (F.col("ymin") + F.col("t") * 250).alias("y")),
        F.struct((F.col("t") * 4 + 2).alias("vid"), (F.col("xmax") - F.col("t") * 250).alias("x"), F.col("ymax").alias("y")),
        F.struct((F.col("t") * 4 + 3).alias("vid"), F.col("xmin").alias("x"), (F.col("ymax") - F.col("t") * 250).alias("y")),
    )).alias("v")).select("insee", "nom", F.col("v.vid").cast("bigint").alias("vid"), F.col("v.x").alias("x"),
                          F.col("v.y").alias("y"))
    bnd = inputs.communes(spark, sf).select("insee", F.explode(F.expr(LN.rings_to_segments("rings"))).alias("s"))
    bnd = bnd.select("insee", "s.x1", "s.y1", "s.x2", "s.y2")
    return shifted_boundary_clusters(pts, bnd)
