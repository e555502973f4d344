"""Per-geometry operators (G1-G19) as table plans over the fixtures.

Spark side: array higher-order functions (``geoqa.functions.lines``), one
narrow projection per table.  Oracle side: the same measures from vertex /
segment rows with window functions, a different formulation of the same
definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import crs
from geoqa.functions import lines as LN
from geoqa.functions.geodesic import geodesic_distance as geodesic_distance_exact
from geoqa.plans import inputs
from geoqa.plans.fixtures import fx, register
from geoqa.plans.registry import query
from geoqa.session import ship_package

E = F.expr

# official roads as segment rows with their length, running length and total
OSEG = ("fx_oseg", """
select a.cleabs, a.k as seg, a.x as x1, a.y as y1, b.x as x2, b.y as y2,
       sqrt(cast((b.x-a.x)*(b.x-a.x)+(b.y-a.y)*(b.y-a.y) as double)) as len
from fx_official a join fx_official b on a.cleabs=b.cleabs and b.k=a.k+1""")
OCUM = ("fx_ocum", """
select *, coalesce(sum(len) over (partition by cleabs order by seg rows between unbounded preceding and 1 preceding), 0) as acc,
       sum(len) over (partition by cleabs) as total
from fx_oseg""")
HOUSE_V = ("fx_house_v", inputs.HOUSE_VERTEX_SQL)
HOUSE_E = ("fx_house_e", inputs.HOUSE_EDGE_SQL)


def _interp_sql(frac: str) -> str:
    """Point at a fraction of each official line from running lengths."""
    return f"""
select cleabs, round(x1 + (x2 - x1) * (case when len = 0 then 0 else ({frac} * total - acc) / len end), 6) as x,
       round(y1 + (y2 - y1) * (case when len = 0 then 0 else ({frac} * total - acc) / len end), 6) as y
from (select *, row_number() over (partition by cleabs order by seg) as rn
      from fx_ocum where acc + len >= {frac} * total) p where rn = 1"""


# ------------------------------------------------------------- G13 G1 G2
@query("to_wgs84", f"""
select id, round({crs.lon_of('x')}, 7) as lon, round({crs.lat_of('y')}, 7) as lat from fx_address""")
def to_wgs84(spark: SparkSession, sf: str) -> DataFrame:
    a = inputs.addresses(spark, sf)
    return a.select("id", F.round(E(crs.lon_of("x")), 7).alias("lon"), F.round(E(crs.lat_of("y")), 7).alias("lat"))


@query("to_mercator", f"""
select id, round({crs.merc_x('lon')}, 3) as x, round({crs.merc_y('lat')}, 3) as y from fx_lonlat""")
def to_mercator(spark: SparkSession, sf: str) -> DataFrame:
    p = fx(spark, sf, "fx_lonlat")
    return p.select("id", F.round(E(crs.merc_x("lon")), 3).alias("x"), F.round(E(crs.merc_y("lat")), 3).alias("y"))


# ------------------------------------------------------------------ G14
_GEO_D = crs.geo_distance("lon", "lat", "lon + 0.001 * (id % 7)", "lat + 0.001 * (id % 5)")


@query("geodesic_distance", f"select id, round({_GEO_D}, 3) as meters from fx_lonlat")
def geodesic_distance(spark: SparkSession, sf: str) -> DataFrame:
    p = fx(spark, sf, "fx_lonlat")
    return p.select("id", F.round(E(_GEO_D), 3).alias("meters"))


# every address to a place up to 11,000 km away, on both hemispheres; the oracle iterates in SQL
_FAR_SQL = "select id, lon as lon1, lat as lat1, lon + id % 120 - 60 as lon2, lat - id % 97 as lat2 from fx_lonlat"
_FLAT = f"(1 - {crs.WGS84_F!r})"
_GI_START = f"""
select id, radians(abs(lon2 - lon1)) as l, radians(abs(lon2 - lon1)) as lam,
       sin(atan({_FLAT} * tan(radians(lat1)))) as s1, cos(atan({_FLAT} * tan(radians(lat1)))) as c1,
       sin(atan({_FLAT} * tan(radians(lat2)))) as s2, cos(atan({_FLAT} * tan(radians(lat2)))) as c2 from gi_far"""


def _gi_step(before: str) -> str:
    return f"""
select id, l, s1, c1, s2, c2, ss, cs, sg, ca2, c2m, l + (1 - cc) * {crs.WGS84_F!r} * sa * (sg + cc * ss * (c2m + cc * cs * (2 * c2m * c2m - 1))) as lam
from (select *, {crs.WGS84_F!r} / 16 * ca2 * (4 + {crs.WGS84_F!r} * (4 - 3 * ca2)) as cc, case when ca2 > 1e-15 then cs - 2 * s1 * s2 / ca2 else 0 end as c2m
  from (select *, 1 - sa * sa as ca2 from (select *, case when ss > 0 then c1 * c2 * sin(lam) / ss else 0 end as sa, atan2(ss, cs) as sg
    from (select id, l, lam, s1, c1, s2, c2, sqrt(power(c2 * sin(lam), 2) + power(c1 * s2 - s1 * c2 * cos(lam), 2)) as ss, s1 * s2 + c1 * c2 * cos(lam) as cs from {before}) a) b) c) d"""


_GI_CTES = (("gi_far", _FAR_SQL), ("gi0", _GI_START), *((f"gi{i}", _gi_step(f"gi{i - 1}")) for i in range(1, 13)), ("gi_u", f"""
select *, ca2 * {crs.WGS84_F * (2 - crs.WGS84_F) / (1 - crs.WGS84_F) ** 2!r} as u from gi12"""))


@query("geodesic_inverse", f"""
select id, round({crs.WGS84_A} * {_FLAT} * (1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))) * (sg - b * ss * (c2m + b / 4 * (
         cs * (2 * c2m * c2m - 1) - b / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))), 2) as meters
from (select *, u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) as b from gi_u) z""", _GI_CTES)
def geodesic_inverse(spark: SparkSession, sf: str) -> DataFrame:
    """Exact distances for any range (Arrow batches of numpy)."""
    register(spark, sf)
    ship_package(spark)
    return spark.sql(_FAR_SQL).select("id", F.round(geodesic_distance_exact("lon1", "lat1", "lon2", "lat2"), 2).alias("meters"))


# ------------------------------------------------------------------ G15
@query("geohash", f"select id, {crs.geohash_ansi('lon', 'lat', 20)} as geohash from fx_lonlat")
def geohash(spark: SparkSession, sf: str) -> DataFrame:
    p = fx(spark, sf, "fx_lonlat")
    return p.select("id", E(crs.geohash("lon", "lat", 20)).alias("geohash"))


# ------------------------------------------------------------------ G4
@query("length_planar", "select cleabs, round(sum(len), 6) as length from fx_oseg group by cleabs", (OSEG,))
def length_planar(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.official_lines(spark, sf).select("cleabs", F.round(E(LN.length("pts")), 6).alias("length"))


_SEG_GEO = crs.geo_distance(crs.lon_of("x1"), crs.lat_of("y1"), crs.lon_of("x2"), crs.lat_of("y2"))


@query("length_geodesic", f"select cleabs, round(sum({_SEG_GEO}), 4) as meters from fx_oseg group by cleabs",
       (OSEG,))
def length_geodesic(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.official_lines(spark, sf).select("cleabs", F.round(E(LN.geo_length("pts")), 4).alias("meters"))


# ------------------------------------------------------------------ G8
@query("midpoint", _interp_sql("0.5"), (OSEG, OCUM))
def midpoint(spark: SparkSession, sf: str) -> DataFrame:
    m = inputs.official_lines(spark, sf).select("cleabs", E(LN.interpolate("pts", "0.5")).alias("p"))
    return m.select("cleabs", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query("line_end", _interp_sql("1.0"), (OSEG, OCUM))
def line_end(spark: SparkSession, sf: str) -> DataFrame:
    m = inputs.official_lines(spark, sf).select("cleabs", E(LN.interpolate("pts", "1.0")).alias("p"))
    return m.select("cleabs", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


# ------------------------------------------------------------------ G3 line
@query("centroid_line", """
select cleabs, round(sum(len * (x1 + x2) / 2) / sum(len), 6) as x, round(sum(len * (y1 + y2) / 2) / sum(len), 6) as y
from fx_oseg group by cleabs""", (OSEG,))
def centroid_line(spark: SparkSession, sf: str) -> DataFrame:
    c = inputs.official_lines(spark, sf).select("cleabs", E(LN.centroid("pts")).alias("c"))
    return c.select("cleabs", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


# ------------------------------------------------------------------ G6 G7 G10
@query("vertex_count", "select cleabs, count(*) as npoints from fx_official group by cleabs")
def vertex_count(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.official_lines(spark, sf).select("cleabs", F.size("pts").cast("bigint").alias("npoints"))


@query("vertex_explode", "select cleabs, cast(k + 1 as bigint) as pos, x, y from fx_official")
def vertex_explode(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.official_lines(spark, sf)
    v = lines.select("cleabs", F.posexplode("pts").alias("p0", "pt"))
    return v.select("cleabs", (F.col("p0") + 1).cast("bigint").alias("pos"), F.col("pt.x").alias("x"),
                    F.col("pt.y").alias("y"))


@query("inner_vertices", """
select cleabs, cast(k + 1 as bigint) as pos, x, y from fx_official o
where k > 0 and k < (select max(k) from fx_official i where i.cleabs = o.cleabs)""")
def inner_vertices(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.official_lines(spark, sf).withColumn("n", F.size("pts"))
    v = lines.select("cleabs", "n", F.posexplode("pts").alias("p0", "pt"))
    v = v.where((F.col("p0") > 0) & (F.col("p0") < F.col("n") - 1))
    return v.select("cleabs", (F.col("p0") + 1).cast("bigint").alias("pos"), F.col("pt.x").alias("x"),
                    F.col("pt.y").alias("y"))


# ------------------------------------------------------------------ G9
_SUB_SQL = """
select cleabs, cast(0 as bigint) as pos, x, y from s0
union all
select v.cleabs, cast(v.k as bigint) as pos, round(cast(v.x as double), 6) as x, round(cast(v.y as double), 6) as y
from fx_official v join (select cleabs, seg, acc, total from fx_ocum) c on c.cleabs = v.cleabs and c.seg = v.k
where c.acc > 0.1 * c.total and c.acc < 0.9 * c.total
union all
select cleabs, cast(99 as bigint) as pos, x, y from s1"""


@query("subline", _SUB_SQL, (OSEG, OCUM, ("s0", _interp_sql("0.1")), ("s1", _interp_sql("0.9"))))
def subline(spark: SparkSession, sf: str) -> DataFrame:
    """Sub-line 0.1-0.9: start point (pos 0), inner vertices (their vertex
    index), end point (pos 99)."""
    lines = inputs.official_lines(spark, sf)
    cum = E("transform(sequence(0, size(pts) - 1), j -> aggregate(filter(sequence(1, greatest(j, 1)), i -> i <= j), cast(0 AS double), "
            "(acc, i) -> acc + sqrt(cast((pts[i].x - pts[i-1].x) * (pts[i].x - pts[i-1].x) + "
            "(pts[i].y - pts[i-1].y) * (pts[i].y - pts[i-1].y) AS double))))")
    s = lines.select("cleabs", "pts", cum.alias("cum"), E(LN.length("pts")).alias("L"),
                     E(LN.interpolate("pts", "0.1")).alias("a"), E(LN.interpolate("pts", "0.9")).alias("b"))
    ends = s.select("cleabs", F.lit(0).cast("bigint").alias("pos"), F.round("a.x", 6).alias("x"),
                    F.round("a.y", 6).alias("y")).unionByName(
        s.select("cleabs", F.lit(99).cast("bigint").alias("pos"), F.round("b.x", 6).alias("x"),
                 F.round("b.y", 6).alias("y")))
    inner = (s.select("cleabs", "cum", "L", F.posexplode("pts").alias("j", "pt"))
              .where((F.expr("cum[j]") > F.lit(0.1) * F.col("L")) & (F.expr("cum[j]") < F.lit(0.9) * F.col("L")))
              .select("cleabs", F.col("j").cast("bigint").alias("pos"),
                      F.round(F.col("pt.x").cast("double"), 6).alias("x"),
                      F.round(F.col("pt.y").cast("double"), 6).alias("y")))
    return ends.unionByName(inner)


# ------------------------------------------------------------------ G17
@query("bbox_expand", """
select cleabs, min(x) - 200 as xmin, min(y) - 200 as ymin, max(x) + 200 as xmax, max(y) + 200 as ymax
from fx_official group by cleabs""")
def bbox_expand(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.official_lines(spark, sf)
    xmin, ymin, xmax, ymax = LN.bbox("pts")
    return lines.select("cleabs", (E(xmin) - 200).alias("xmin"), (E(ymin) - 200).alias("ymin"),
                        (E(xmax) + 200).alias("xmax"), (E(ymax) + 200).alias("ymax"))


# ------------------------------------------------------------------ G12
_CP_SQL = """
select cleabs, round(cx, 6) as x, round(cy, 6) as y from (
  select s.cleabs, s.seg, x1 + (x2 - x1) * t as cx, y1 + (y2 - y1) * t as cy,
         row_number() over (partition by s.cleabs order by
           (x1 + (x2 - x1) * t - p.x) * (x1 + (x2 - x1) * t - p.x) + (y1 + (y2 - y1) * t - p.y) * (y1 + (y2 - y1) * t - p.y),
           s.seg) as rn
  from (select *, case when (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) = 0 or (px-x1)*(x2-x1)+(py-y1)*(y2-y1) <= 0 then 0.0
                       when (px-x1)*(x2-x1)+(py-y1)*(y2-y1) >= (x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) then 1.0
                       else cast((px-x1)*(x2-x1)+(py-y1)*(y2-y1) as double) / ((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) end as t
        from (select o.*, v.x as px, v.y as py from fx_oseg o join fx_vertex v on v.osm_id = o.cleabs and v.k = 0) q) s
  join (select osm_id, x, y from fx_vertex where k = 0) p on p.osm_id = s.cleabs) z
where rn = 1"""


@query("closest_point", _CP_SQL, (OSEG,))
def closest_point(spark: SparkSession, sf: str) -> DataFrame:
    """Point of each official road closest to the first vertex of the OSM way
    with the same number."""
    lines = inputs.official_lines(spark, sf)
    p = fx(spark, sf, "fx_vertex").where("k = 0").select(F.col("osm_id").alias("cleabs"), "x", "y")
    j = lines.join(p, "cleabs").select("cleabs", E(LN.closest_point("pts", "x", "y")).alias("c"))
    return j.select("cleabs", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


# ------------------------------------------------------------------ polygons
_RING_AREA = """
select osm_id, ring, abs(sum(x1 * y2 - x2 * y1)) / 2.0 as a,
       sum((x1 + x2) * (x1 * y2 - x2 * y1)) / 6.0 * sign(sum(x1 * y2 - x2 * y1)) as mx,
       sum((y1 + y2) * (x1 * y2 - x2 * y1)) / 6.0 * sign(sum(x1 * y2 - x2 * y1)) as my
from fx_house_e group by osm_id, ring"""


@query("area_polygon", """
select osm_id, round(sum(case when ring = 0 then a else -a end), 6) as area from ra group by osm_id""",
       (HOUSE_V, HOUSE_E, ("ra", _RING_AREA)))
def area_polygon(spark: SparkSession, sf: str) -> DataFrame:
    h = inputs.houses(spark, sf)
    return h.select("osm_id", F.round(E(LN.area("rings")), 6).alias("area"))


_GEO_AREA = (f"{LN.area('rings')} * {crs.scale_e('c.y')} * {crs.scale_n('c.y')}")


@query("area_geodesic", f"""
select r.osm_id, cast(round(sum(case when ring = 0 then a else -a end) * {crs.scale_e('max(c.y)')} * {crs.scale_n('max(c.y)')}, 0) as bigint) as m2
from ra r join cen c on c.osm_id = r.osm_id group by r.osm_id""",
       (HOUSE_V, HOUSE_E, ("ra", _RING_AREA), ("cen", f"""
select osm_id, sum(case when ring = 0 then mx else -mx end) / sum(case when ring = 0 then a else -a end) as x,
       sum(case when ring = 0 then my else -my end) / sum(case when ring = 0 then a else -a end) as y
from ({_RING_AREA}) q group by osm_id""")))
def area_geodesic(spark: SparkSession, sf: str) -> DataFrame:
    """Ground area in m2, rounded half-even to an integer (``::int``): planar
    area times the local Mercator scale factors at the centroid."""
    h = inputs.houses(spark, sf).select("osm_id", "rings", E(LN.polygon_centroid("rings")).alias("c"))
    return h.select("osm_id", F.rint(E(_GEO_AREA)).cast("bigint").alias("m2"))


@query("centroid_polygon", """
select osm_id, round(sum(case when ring = 0 then mx else -mx end) / sum(case when ring = 0 then a else -a end), 6) as x,
       round(sum(case when ring = 0 then my else -my end) / sum(case when ring = 0 then a else -a end), 6) as y
from ra group by osm_id""", (HOUSE_V, HOUSE_E, ("ra", _RING_AREA)))
def centroid_polygon(spark: SparkSession, sf: str) -> DataFrame:
    h = inputs.houses(spark, sf).select("osm_id", E(LN.polygon_centroid("rings")).alias("c"))
    return h.select("osm_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


_POS_SQL = """
select osm_id, round((x0 + x1) / 2, 6) as x, round(s, 6) as y from (
  select osm_id, s, x0, x1, row_number() over (partition by osm_id order by x1 - x0 desc, k) as rn from (
    select osm_id, s, cast(floor((rn - 1) / 2) as bigint) as k, min(xc) as x0, max(xc) as x1 from (
      select e.osm_id, sc.s, e.x1 + (e.x2 - e.x1) * (sc.s - e.y1) / (e.y2 - e.y1) as xc,
             row_number() over (partition by e.osm_id order by e.x1 + (e.x2 - e.x1) * (sc.s - e.y1) / (e.y2 - e.y1)) as rn
      from fx_house_e e join sc on sc.osm_id = e.osm_id
      where (e.y1 > sc.s) <> (e.y2 > sc.s)) c
    group by osm_id, s, cast(floor((rn - 1) / 2) as bigint)) w) z
where rn = 1"""
_SCAN_SQL = """
select v.osm_id, (max(case when v.y <= m.cy then v.y end) + coalesce(min(case when v.y > m.cy then v.y end), max(v.y))) / 2.0 as s
from fx_house_v v join (select osm_id, (min(y) + max(y)) / 2.0 as cy from fx_house_v group by osm_id) m on m.osm_id = v.osm_id
group by v.osm_id"""


@query("point_on_surface", _POS_SQL, (HOUSE_V, HOUSE_E, ("sc", _SCAN_SQL)))
def point_on_surface(spark: SparkSession, sf: str) -> DataFrame:
    h = inputs.houses(spark, sf).select("osm_id", E(LN.point_on_surface("rings")).alias("p"))
    return h.select("osm_id", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query("boundary_segments", """
select osm_id, cast(ring as bigint) as ring, cast(i + 1 as bigint) as seg, x1, y1, x2, y2 from fx_house_e""", (HOUSE_V, HOUSE_E))
def boundary_segments(spark: SparkSession, sf: str) -> DataFrame:
    h = inputs.houses(spark, sf).select("osm_id", F.explode(E(LN.rings_to_segments("rings"))).alias("s"))
    return h.select("osm_id", F.col("s.ring").cast("bigint").alias("ring"), F.col("s.seg").cast("bigint").alias("seg"),
                    "s.x1", "s.y1", "s.x2", "s.y2")
