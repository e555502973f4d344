"""Offset checks: C7 (shifted admin vertices), C19 (road number or shift
along the road), C20 (most shifted vertex of a way)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoqa.functions import geom as G
from geoqa.functions import lines as LN
from geoqa.functions import text as T
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Point
from geoqa.plans import inputs
from geoqa.plans.checks_common import (DEPT_POLY, DEPT_SQL, departments, geohash_col, geohash_sql, line_segments,
                                       lonlat_cols, lonlat_sql, with_midpoint)
from geoqa.plans.checks_dist import BDTOPO_SQL, O_CTES, _lines_with
from geoqa.plans.fixtures import fx, register
from geoqa.plans.ops_joins import SEG_S, band
from geoqa.plans.registry import query
from geoqa.plans.sqlkit import interp_sql, line_ctes

# ---------------------------------------------------------------- C7
# official commune outlines: the OSM communes moved by (insee*37)%200 units
OFFICIAL_COMMUNE_SQL = """
select c.insee, n.n_name as nom, c.xmin + (c.insee * 37) % 200 as xmin, c.ymin + (c.insee * 37) % 200 as ymin,
       c.xmax + (c.insee * 37) % 200 as xmax, c.ymax + (c.insee * 37) % 200 as ymax
from fx_commune c join nation n on n.n_nationkey = c.insee"""
_OFF_VERT = """
select insee, nom, xmin as x, ymin as y from offc union all select insee, nom, xmax, ymin from offc
union all select insee, nom, xmax, ymax from offc union all select insee, nom, xmin, ymax from offc"""
_BND_SEG = """
select insee, xmin as x1, ymin as y1, xmax as x2, ymin as y2 from fx_commune
union all select insee, xmax, ymin, xmax, ymax from fx_commune
union all select insee, xmax, ymax, xmin, ymax from fx_commune
union all select insee, xmin, ymax, xmin, ymin from fx_commune"""


def shifted_admin_vertices(official: DataFrame, osm_boundaries: DataFrame, min_m: float = 100.0) -> DataFrame:
    """7170/40: vertices of official commune outlines lying more than
    ``min_m`` ground metres from the OSM boundary of the same commune;
    grouped by position with the largest offset and the communes involved.

    official: insee, nom, rings; osm_boundaries: insee, x1, y1, x2, y2.
    Vertices with a boundary segment within ``min_m`` are removed by a grid
    anti-join; the remaining ones look for their nearest segment in growing rings.
    """
    v = official.select("insee", "nom", F.explode(F.flatten("rings")).alias("p")).select(
        "insee", "nom", F.col("p.x").alias("x"), F.col("p.y").alias("y")).distinct()
    v = SJ.with_geo_scales(v, "y")
    geo = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), str(min_m), scales=SJ.L_SCALES)
    far = SJ.dwithin_join(v, osm_boundaries.withColumnRenamed("insee", "b_insee"), SJ.Ground(min_m),
                          residual=f"l.insee = r.b_insee AND {geo}", how="left_anti")
    dist = SJ.nearest_join(far, osm_boundaries.withColumnRenamed("insee", "b_insee"), key=("insee", "x", "y"), by=(("insee", "b_insee"),),
                           start=2 * min_m, distance=SJ.geo_pt_seg_d("x", "y", ("x1", "y1", "x2", "y2"), scales=("_sx", "_sy")), scale="least(_sx, _sy)")
    g = dist.groupBy("x", "y").agg(
        F.max(F.round("d", 1)).alias("dist_m"),
        F.array_join(F.array_sort(F.collect_set(F.format_string("%s (%s)", "nom", F.col("insee").cast("string")))),
                     ", ").alias("communes"))
    return g.select(*lonlat_cols("x", "y"), "dist_m", "communes")


@query("c07_shifted_admin_vertices", f"""
select {lonlat_sql('x', 'y')}, max(round(d, 1)) as dist_m,
       string_agg(distinct format('{{}} ({{}})', nom, insee), ', ' order by format('{{}} ({{}})', nom, insee)) as communes
from (select v.insee, v.nom, v.x, v.y, min({SJ.geo_pt_seg_d('v.x', 'v.y', ('b.x1', 'b.y1', 'b.x2', 'b.y2'))}) as d
      from offv v join bnd b on b.insee = v.insee group by v.insee, v.nom, v.x, v.y) z
where d > 100 group by x, y""", (("offc", OFFICIAL_COMMUNE_SQL), ("offv", _OFF_VERT), ("bnd", _BND_SEG)))
def c07(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    off = spark.sql(OFFICIAL_COMMUNE_SQL).select("insee", "nom", F.expr(G.box_rings("xmin", "ymin", "xmax", "ymax")).alias("rings"))
    bnd = inputs.communes(spark, sf).select("insee", F.explode(F.expr(LN.rings_to_segments("rings"))).alias("s"))
    bnd = bnd.select("insee", "s.x1", "s.y1", "s.x2", "s.y2")
    return shifted_admin_vertices(off, bnd)


# ---------------------------------------------------------------- C19
def road_ref_or_shift(lines: DataFrame, areas: DataFrame, way_segs: DataFrame, min_points: int = 10,
                      coarse: float = 50.0, fine_m: float = 10.0) -> DataFrame:
    """7170/3 (official roads): numbered roads with more than ``min_points``
    vertices (not roundabouts or ramps) where some vertex of the middle 80 %
    has no highway within ``coarse`` units and ``fine_m`` m carrying the same
    number, a ``_link`` class or a junction tag.  One row per road."""
    sel = lines.where(F.col("num_route").isNotNull() & ~F.col("nature").isin("Rond-point", "Bretelle")
                      & (F.size("pts") > min_points))
    m = with_midpoint(sel)
    inside = SJ.contains_join(m.select("cleabs", "mx", "my"), areas, ("dept",), point=Point("mx", "my"), polygon=DEPT_POLY)
    m = m.join(inside.select("cleabs").distinct(), "cleabs", "left_semi")
    sub = m.select("cleabs", "num_route", "precision", "mx", "my",
                   F.explode(F.expr(LN.substring("pts", "0.1", "0.9"))).alias("v"))
    sub = sub.select("cleabs", "num_route", "precision", "mx", "my", F.col("v.x").alias("vx"), F.col("v.y").alias("vy"))
    sub = SJ.with_geo_scales(sub, "vy")
    h = way_segs.where("highway IS NOT NULL").select(
        "x1", "y1", "x2", "y2", F.upper(T.strip_spaces("ref")).alias("rref"),
        F.col("highway").like("%_link").alias("is_link"), F.element_at("tags", "junction").isNotNull().alias("has_jct"))
    geo = SJ.geo_pt_seg_within("l.vx", "l.vy", ("r.x1", "r.y1", "r.x2", "r.y2"), str(fine_m), scales=SJ.L_SCALES)
    planar = G.pt_seg_within("l.vx", "l.vy", "r.x1", "r.y1", "r.x2", "r.y2", str(coarse))
    lonely = SJ.dwithin_join(sub, h, SJ.Ground(fine_m, planar=coarse), left_geom=Point("vx", "vy"),
                             residual=f"{planar} AND {geo} AND (l.num_route = r.rref OR r.is_link OR r.has_jct)",
                             how="left_anti")
    out = lonely.select("mx", "my", "num_route", "precision").distinct()
    return out.select(geohash_col("mx", "my"), *lonlat_cols("mx", "my", 7),
                      F.format_string("%s (%s)", F.coalesce("num_route", F.lit("ROUTE")), "precision").alias("text"))


_C19_VERTS = """
select id, 0.1 as f, x, y from s01 union all select id, 0.9, x, y from s09
union all select c.id, 0.5, cast(c.x1 as double), cast(c.y1 as double) from o_cum c
where c.acc > 0.1 * c.total and c.acc < 0.9 * c.total"""
_C19_GEO = SJ.geo_pt_seg_within("v.x", "v.y", SEG_S, "10.0")


@query("c19_road_ref_or_shift", f"""
select distinct {geohash_sql('m.x', 'm.y')}, {lonlat_sql('m.x', 'm.y', 7)},
       format('{{}} ({{}})', coalesce(b.num_route, 'ROUTE'), '2.5') as text
from (select distinct o.cleabs, o.num_route, o.nature from fx_official o) b
join o_mid m on m.id = b.cleabs join sv v on v.id = b.cleabs
where b.num_route is not null and b.nature not in ('Rond-point', 'Bretelle')
and (select count(*) from fx_dense z where z.cleabs = b.cleabs) > 10
and exists (select 1 from dep d where m.x between d.xmin and d.xmax and m.y between d.ymin and d.ymax)
and not exists (select 1 from fx_segment s join fx_way w on w.osm_id = s.osm_id
                where s.highway is not null and {band('v.x', 'v.y', SEG_S, 12)}
                and {G.pt_seg_within('v.x', 'v.y', *SEG_S, '50.0')} and {_C19_GEO}
                and (b.num_route = upper(replace(s.ref, ' ', '')) or w.hw_class like '%_link' or w.junction is not null))""",
       line_ctes("o", "fx_dense", "cleabs") + (("s01", interp_sql("o_cum", "0.1")), ("s09", interp_sql("o_cum", "0.9")), ("sv", _C19_VERTS),
                 ("dep", DEPT_SQL)))
def c19(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.dense_lines(spark, sf).join(_lines_with(spark, sf, BDTOPO_SQL).drop("pts"), "cleabs").join(
        inputs.official_lines(spark, sf).select("cleabs", "num_route"), "cleabs").withColumn("precision", F.lit("2.5"))
    return road_ref_or_shift(lines, departments(spark, sf), inputs.osm_way_segments(spark, sf))


# ---------------------------------------------------------------- C20
def most_shifted_vertex(ways: DataFrame, areas: DataFrame, official_segs: DataFrame, dist: float = 100.0,
                        min_m: float = 10.0) -> DataFrame:
    """7170/4: for each public major OSM way with its midpoint in an area,
    match every inner vertex to the nearest official road within ``dist``,
    keep the way's worst vertex, report it if it is more than ``min_m`` m off."""
    w = ways.where((F.col("osm_id") > 0) & F.col("highway").rlike(T.MAJOR_HIGHWAY_PATTERN)
                   & ~F.coalesce(F.element_at("tags", "access"), F.lit("")).isin("private", "no"))
    m = with_midpoint(w)
    inside = SJ.contains_join(m.select("osm_id", "mx", "my"), areas, ("dept",), point=Point("mx", "my"), polygon=DEPT_POLY)
    w = w.join(inside.select("osm_id").distinct(), "osm_id", "left_semi")
    v = (w.select("osm_id", "name", "ref", "highway", F.size("pts").alias("n"), F.posexplode("pts").alias("pos", "p"))
          .where((F.col("pos") > 0) & (F.col("pos") < F.col("n") - 1))
          .select("osm_id", "name", "ref", "highway", "pos", F.col("p.x").alias("x"), F.col("p.y").alias("y")))
    # nearest road of each vertex, then the worst vertex of each way: no sort of all pairs
    near = SJ.nearest_within(v, official_segs.withColumnRenamed("seg", "oseg"), dist, key=("osm_id",), pick=("cleabs", "oseg", "x1", "y1", "x2", "y2"))
    near = v.join(near, ["osm_id", "x", "y"])
    row = F.struct(*[F.col(c) for c in near.columns])
    worst = near.groupBy("osm_id").agg(F.min_by(row, F.struct(-F.col("d2"), F.col("pos"))).alias("r")).select("r.*")
    worst = worst.withColumn("geo", F.expr(SJ.geo_len_to_closest("x", "y", ("x1", "y1", "x2", "y2"))))
    worst = worst.where(F.col("geo") > min_m)
    return worst.select("osm_id", "name", "ref", "highway", geohash_col("x", "y"), *lonlat_cols("x", "y", 7),
                        F.round("geo", 1).alias("dist_m"))


_C20_D2 = G.pt_seg_d2("v.x", "v.y", "t.x1", "t.y1", "t.x2", "t.y2")
_C20_GEO = SJ.geo_len_to_closest("x", "y", ("x1", "y1", "x2", "y2"))


@query("c20_most_shifted_vertex", f"""
select osm_id, name, ref, highway, {geohash_sql('x', 'y')}, {lonlat_sql('x', 'y', 7)}, round({_C20_GEO}, 1) as dist_m
from (select *, row_number() over (partition by osm_id order by d2 desc, k) as n2 from (
        select v.osm_id, w.name, w.ref, w.hw_class as highway, v.k, v.x, v.y, t.x1, t.y1, t.x2, t.y2, {_C20_D2} as d2,
               row_number() over (partition by v.osm_id, v.x, v.y order by {_C20_D2}, t.id, t.seg) as n1
        from fx_vertex v join fx_way w on w.osm_id = v.osm_id join w_mid m on m.id = v.osm_id
        join o_seg t on least(t.x1, t.x2) - 100 <= v.x and v.x <= greatest(t.x1, t.x2) + 100
                    and least(t.y1, t.y2) - 100 <= v.y and v.y <= greatest(t.y1, t.y2) + 100
                    and {G.pt_seg_within('v.x', 'v.y', 't.x1', 't.y1', 't.x2', 't.y2', '100')}
        where v.osm_id > 0 and regexp_matches(w.hw_class, '{T.MAJOR_HIGHWAY_PATTERN}')
        and coalesce(w.access, '') not in ('private', 'no')
        and v.k > 0 and v.k < (select max(k) from fx_vertex q where q.osm_id = v.osm_id)
        and exists (select 1 from dep d where m.x between d.xmin and d.xmax and m.y between d.ymin and d.ymax)) a
      where n1 = 1) b
where n2 = 1 and {_C20_GEO} > 10""",
       O_CTES + line_ctes("w", "fx_vertex", "osm_id") + (("dep", DEPT_SQL),))
def c20(spark: SparkSession, sf: str) -> DataFrame:
    segs = line_segments(inputs.official_lines(spark, sf).select("cleabs", "pts"))
    return most_shifted_vertex(inputs.osm_ways(spark, sf), departments(spark, sf), segs)


# ---------------------------------------------------------------- W2
def topn_worst_vertices(ways: DataFrame, official_segs: DataFrame, n: int = 3, dist: float = 100.0) -> DataFrame:
    """The ``n`` inner vertices of each way that lie farthest from their nearest official road within
    ``dist``: osm_id, rank, vertex and squared distance.  Only the rank is a window, over one row a vertex."""
    v = (ways.select("osm_id", F.size("pts").alias("n"), F.posexplode("pts").alias("pos", "p")).where("pos > 0 and pos < n - 1")
         .select("osm_id", "pos", F.col("p.x").alias("x"), F.col("p.y").alias("y")))
    j = SJ.dwithin_join(v, official_segs.select("x1", "y1", "x2", "y2"), dist)
    near = j.groupBy("osm_id", "pos").agg(F.min(F.expr(G.pt_seg_d2("x", "y", "x1", "y1", "x2", "y2"))).alias("d2"))
    w = Window.partitionBy("osm_id").orderBy(F.desc("d2"), "pos")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


_TOPN_D2 = """power(v.x - t.x1 - u * (t.x2 - t.x1), 2) + power(v.y - t.y1 - u * (t.y2 - t.y1), 2)"""


@query("topn_worst_vertex", f"""
select osm_id, pos, rank, round(d2, 4) as d2 from (
  select osm_id, pos, d2, row_number() over (partition by osm_id order by d2 desc, pos) as rank from (
    select v.osm_id, v.k as pos, min({_TOPN_D2}) as d2
    from fx_vertex v join o_seg t on least(t.x1, t.x2) - 100 <= v.x and v.x <= greatest(t.x1, t.x2) + 100
      and least(t.y1, t.y2) - 100 <= v.y and v.y <= greatest(t.y1, t.y2) + 100,
    lateral (select least(1.0, greatest(0.0, ((v.x - t.x1) * (t.x2 - t.x1) + (v.y - t.y1) * (t.y2 - t.y1))
             / greatest(cast((t.x2 - t.x1) * (t.x2 - t.x1) + (t.y2 - t.y1) * (t.y2 - t.y1) as double), 1e-30))) as u) q
    where v.k in (1, 2) and {_TOPN_D2} <= 10000 group by v.osm_id, v.k) m) r
where rank <= 1""", O_CTES)
def topn_worst_vertex(spark: SparkSession, sf: str) -> DataFrame:
    segs = line_segments(inputs.official_lines(spark, sf).select("cleabs", "pts"))
    r = topn_worst_vertices(inputs.osm_ways(spark, sf).select("osm_id", "pts"), segs, n=1)
    return r.select("osm_id", F.col("pos").cast("bigint").alias("pos"), F.col("rank").cast("bigint").alias("rank"), F.round("d2", 4).alias("d2"))
