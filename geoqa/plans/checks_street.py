"""Street-name checks built on address hulls: A10 / A12 plans and C1."""

from __future__ import annotations

import string

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoqa.functions import crs
from geoqa.functions import lines as LN
from geoqa.functions import text as T
from geoqa.operators import hull as H
from geoqa.operators.hullways import hull_way_sums
from geoqa.plans import inputs
from geoqa.functions import geom as G
from geoqa.plans.checks_common import lonlat_cols
from geoqa.plans.checks_common import lonlat_sql as _lonlat_sql
from geoqa.plans.fixtures import register
from geoqa.plans.registry import query

# addresses with a 10-character street key (dept 2, commune 3, street 4, check letter 1);
# one street in eight is a lettered locality (5th character from the end is a letter)
_FANTOIR_TXT = """concat('75056', case when {k} % 8 = 0 then concat('A', lpad(cast({k} % 1000 as string), 3, '0'))
                            else lpad(cast({k} % 10000 as string), 4, '0') end,
              substr('ABCDEFGHJKLMNPRSTUVWXYZ', cast({k} % 23 + 1 as int), 1))"""
CUMUL_SQL = f"""
select {_FANTOIR_TXT.format(k='fantoir')} as fantoir,
       case when fantoir % 3 = 0 then voie end as voie_cadastre,
       case when fantoir % 3 <> 0 then voie end as voie_autre,
       case when fantoir % 6 = 1 then voie end as voie_osm,
       source, x, y
from fx_street_address"""

STREET_KEY_PATTERN = "[0-9]....$"  # numbered street, not a lettered locality (fixed value)


def missing_streets_fill(addresses: DataFrame) -> DataFrame:
    """Address groups whose street has no matched OSM name: key + name,
    address count (> 1) and the convex hull of the addresses (C1)."""
    a = addresses.where(T.blank("voie_osm") & (F.col("source") != "CADASTRE")
                        & F.col("fantoir").rlike(STREET_KEY_PATTERN))
    a = a.select("fantoir", F.coalesce("voie_cadastre", "voie_autre").alias("voie"), "x", "y")
    a = a.withColumn("voie_key", F.to_json(F.struct("voie")))  # a group without a name is a group, too
    counts = a.groupBy("fantoir", "voie_key").agg(F.first("voie").alias("voie"), F.count("*").alias("nb")).where("nb > 1")
    hulls = H.convex_hull(a.select("fantoir", "voie_key", "x", "y").join(counts.select("fantoir", "voie_key"), ["fantoir", "voie_key"], "left_semi"),
                          ("fantoir", "voie_key"))
    return counts.join(hulls, ["fantoir", "voie_key"]).drop("voie_key")


def _cumul(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf)
    return spark.sql(CUMUL_SQL)


_A = f"""select fantoir, coalesce(voie_cadastre, voie_autre) as voie, x, y from ca
where coalesce(voie_osm, '') = '' and source <> 'CADASTRE' and regexp_matches(fantoir, '{STREET_KEY_PATTERN}')"""
_G = "select fantoir, voie, count(*) as nb from a group by fantoir, voie having count(*) > 1"
_P = "select distinct a.fantoir, a.voie, a.x, a.y from a join g on g.fantoir = a.fantoir and g.voie = a.voie"
_CR = "((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x))"
_HV = f"""
select p.fantoir, p.voie, p.x, p.y from p where exists (
  select 1 from p q where q.fantoir = p.fantoir and q.voie = p.voie and (q.x <> p.x or q.y <> p.y)
  and not exists (select 1 from p r where r.fantoir = p.fantoir and r.voie = p.voie and not (
      {_CR} > 0 or ({_CR} = 0 and (r.x - p.x) * (q.x - p.x) + (r.y - p.y) * (q.y - p.y) >= 0))))
union all
select fantoir, voie, min(x), min(y) from p group by fantoir, voie having count(*) = 1"""
HULL_CTES = (("ca", CUMUL_SQL), ("a", _A), ("g", _G), ("p", _P), ("hv", _HV))


@query("c01_missing_streets_fill", """
select g.fantoir, g.voie, g.nb, count(*) as nverts from g join hv on hv.fantoir = g.fantoir and hv.voie = g.voie
group by g.fantoir, g.voie, g.nb""", HULL_CTES)
def c01(spark: SparkSession, sf: str) -> DataFrame:
    r = missing_streets_fill(_cumul(spark, sf))
    return r.select("fantoir", "voie", "nb", F.col("nverts").cast("bigint").alias("nverts"))


@query("hull_vertices", "select fantoir, voie, cast(x as double) as x, cast(y as double) as y from hv", HULL_CTES)
def hull_vertices(spark: SparkSession, sf: str) -> DataFrame:
    r = missing_streets_fill(_cumul(spark, sf))
    return (r.select("fantoir", "voie", "nverts", F.posexplode("hull").alias("i", "p"))
             .where(F.col("i") < F.col("nverts"))
             .select("fantoir", "voie", F.col("p.x").alias("x"), F.col("p.y").alias("y")))


@query("hull_diameter", """
select a.fantoir, a.voie, round(sqrt(max((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 6) as diameter
from p a join p b on a.fantoir = b.fantoir and a.voie = b.voie group by a.fantoir, a.voie""", HULL_CTES)
def hull_diameter(spark: SparkSession, sf: str) -> DataFrame:
    r = missing_streets_fill(_cumul(spark, sf))
    return r.select("fantoir", "voie", F.round(H.hull_diameter(r), 6).alias("diameter"))


# ---------------------------------------------------------------- C2
def _longest_geo(pts: str) -> str:
    """Ground length of the longest vertex-to-vertex line of a point array
    (ST_LongestLine, then geography length); ties on the planar length keep
    the longer ground length."""
    d2 = "((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y))"
    my = "((p.y + q.y) / 2.0)"
    g = f"sqrt(power((q.x - p.x) * {crs.scale_e(my)}, 2) + power((q.y - p.y) * {crs.scale_n(my)}, 2))"
    # planar maximum first (plain arithmetic), ground length only for the pairs reaching it
    m = f"aggregate({pts}, -1D, (s, p) -> aggregate({pts}, s, (t, q) -> greatest(t, cast({d2} AS double))))"
    return (f"element_at(transform(array({m}), m_ -> aggregate({pts}, 0D, (s, p) -> aggregate({pts}, s, (t, q) -> "
            f"CASE WHEN cast({d2} AS double) = m_ THEN greatest(t, {g}) ELSE t END))), 1)")


#: Vertices up to which all pairs of a way are compared in place; longer ways take their hull first.
FEW = 32


def _ground(p: str, q: str) -> str:
    my = f"(({p}.y + {q}.y) / 2.0)"
    return f"sqrt(power(({q}.x - {p}.x) * {crs.scale_e(my)}, 2) + power(({q}.y - {p}.y) * {crs.scale_n(my)}, 2))"


def longest_lines(ways: DataFrame) -> DataFrame:
    """``osm_id, wl``: ground length of the longest vertex-to-vertex line of each way (osm_id, pts).  The ends of the
    longest line are vertices of the hull, where calipers find them in linear time."""
    few = ways.where(F.size("pts") <= FEW).select("osm_id", F.expr(_longest_geo("pts")).alias("wl"))
    many = ways.where(F.size("pts") > FEW).select("osm_id", F.explode("pts").alias("p")).select("osm_id", "p.x", "p.y")
    hulls = H.convex_hull(many, ("osm_id",))
    return few.unionByName(hulls.select("osm_id", F.expr(H.calipers("hull", _ground("p_", "q_"))).alias("wl")))


def street_name_check(groups: DataFrame, status: DataFrame, ways: DataFrame, dist: float = 20.0,
                      extent_m: float = 100.0) -> DataFrame:
    """7170/30-33: :func:`street_measures`, then :func:`classify_streets`; streets without a nearby
    way or without a place in the order come first, as in the published report."""
    out = classify_streets(street_measures(groups, status, ways, dist), extent_m)
    return out.orderBy(F.desc_nulls_first("l_noname"), F.desc_nulls_first("l"), "fantoir", "voie").select(
        "fantoir", "voie", "class", "way", "lon", "lat")


def street_measures(groups: DataFrame, status: DataFrame, ways: DataFrame, dist: float = 20.0) -> DataFrame:
    """Unmatched address groups (their hull) against the highways within
    ``dist``, with the overlaps that decide: no way -> 33; one (nameless) way covering the
    hull -> 32 add name; one named way -> 31 change name; names already
    matching -> dropped; otherwise 30.

    groups: fantoir, voie, nb, hull (closed counter-clockwise ring), nverts;
    status: fantoir (streets already handled); ways: osm_id, name, highway, pts.
    """
    g = (groups.where((F.col("nverts") >= 2) & F.col("fantoir").rlike(STREET_KEY_PATTERN))
               .join(status, "fantoir", "left_anti")
               .withColumn("hrings", F.array("hull"))
               .withColumn("hx0", F.expr("array_min(transform(hull, p -> p.x))"))
               .withColumn("hy0", F.expr("array_min(transform(hull, p -> p.y))"))
               .withColumn("hx1", F.expr("array_max(transform(hull, p -> p.x))"))
               .withColumn("hy1", F.expr("array_max(transform(hull, p -> p.y))"))
               .persist(StorageLevel.MEMORY_AND_DISK))  # read by two branches; hulls are Python-built
    hw = ways.where(F.col("highway").isNotNull())
    # a way comes whole: what groups and ways have in common is summed up cell by cell, not pair by pair
    bx = ("wx0", "wy0", "wx1", "wy1")
    ym = "((w_.y1 + w_.y2) / 2.0)"
    wsegs = (f"transform({LN.line_to_segments('pts')}, w_ -> named_struct('x1', w_.x1, 'y1', w_.y1, 'x2', w_.x2, 'y2', w_.y2, "
             f"'len', sqrt(cast((w_.x2 - w_.x1) * (w_.x2 - w_.x1) + (w_.y2 - w_.y1) * (w_.y2 - w_.y1) AS double)), "
             f"'glen', sqrt(power((w_.x2 - w_.x1) * {crs.scale_e(ym)}, 2) + power((w_.y2 - w_.y1) * {crs.scale_n(ym)}, 2))))")
    whole = hw.where("osm_id IS NOT NULL").select(
        "osm_id", "name", F.expr(wsegs).alias("wsegs"),
        F.count("*").over(Window.partitionBy("osm_id")).alias("_copies"), *[F.expr(e).alias(n) for e, n in zip(LN.bbox("pts"), bx)])
    # a pattern without special signs stands in one name; the others are looked for in all names of a group (None)
    voie_c = F.replace("voie", F.lit('"'), F.lit(""))
    pattern = F.translate(T.unbracket(voie_c), string.ascii_uppercase, string.ascii_lowercase)
    pattern = F.when((pattern != "") & ~pattern.rlike(r"[.^$|;*+?\[\]{}\\()]"), pattern)
    hulls = g.where("voie IS NOT NULL").select("fantoir", "voie", "hrings", "hx0", "hy0", "hx1", "hy1", pattern.alias("_pattern"))
    agg = hull_way_sums(hulls, whole, dist, ("fantoir", "voie"))
    agg = agg.persist(StorageLevel.MEMORY_AND_DISK)  # read for the extents, too
    # the extent of a way counts only where it is a group's one way, or its one nameless way
    asked = agg.select(F.explode(F.array("one", "one_noname")).alias("osm_id")).where("osm_id IS NOT NULL").distinct()
    extent = longest_lines(asked.join(hw.select("osm_id", "pts"), "osm_id"))
    agg = (agg.join(extent.select(F.col("osm_id").alias("one"), F.col("wl").alias("l_ways")), "one", "left")
              .join(extent.select(F.col("osm_id").alias("one_noname"), F.col("wl").alias("l_ways_noname")), "one_noname", "left"))
    names = F.array_join(F.array_sort("names"), ";")
    agg = agg.withColumn("unnamed", (F.col("n_named") == 0) | ((F.col("n_named") == 1) & (F.col("name") == "")))

    cen = F.expr(f"CASE WHEN nverts >= 3 THEN {LN.polygon_centroid('array(hull)')} "
                 f"ELSE named_struct('x', (hull[0].x + hull[1].x) / 2.0, 'y', (hull[0].y + hull[1].y) / 2.0) END")
    return (g.join(agg, ["fantoir", "voie"], "left")
          .where(F.coalesce("name", F.lit("")) != F.col("voie"))
          .withColumn("c", cen)
          .withColumn("l", F.try_divide("slb", "sl")).withColumn("l2", F.col("sg") - F.col("sgh"))
          .withColumn("l_noname", F.try_divide("nslb", "nsl")).withColumn("l2_noname", F.col("nsg") - F.col("nsgh"))
          .withColumn("l_geom", F.expr(H.calipers("hull", _ground("p_", "q_"))))
          .withColumn("voie_c", voie_c)
          .withColumn("same", F.when(~F.col("unnamed"), F.when(pattern.isNotNull(), F.col("fits")).otherwise(
              T.matches_ci(F.replace(names, F.lit('"'), F.lit("")), T.unbracket("voie_c"))))))


def classify_streets(j: DataFrame, extent_m: float = 100.0) -> DataFrame:
    """The class of each measured street (names that match already are dropped) and the way it is about."""
    up = F.upper("voie_c") != F.col("voie_c")
    fits_nn = ((F.col("l_geom") - F.col("l_ways_noname") < extent_m)
               & (((F.col("l_noname") > 0.5) & (F.col("l2_noname") < extent_m)) | (F.col("l_noname") > 0.75)))
    fits = ((F.col("l_geom") - F.col("l_ways") < extent_m)
            & (((F.col("l") > 0.5) & (F.col("l2") < extent_m)) | (F.col("l") > 0.75)))
    one_nn, one = F.col("one_noname").isNotNull(), F.col("one").isNotNull()
    cls = (F.when(F.col("n").isNull(), 33)
            .when(one_nn & fits_nn & up, 32)
            .when(one & fits & F.col("unnamed") & up, 32)
            .when(one & fits & ~F.col("unnamed") & up, 31)
            .when(F.col("same"), None).otherwise(30))
    way = (F.when(F.col("n").isNull(), None)
            .when(one_nn & fits_nn & up, F.col("one_noname"))
            .when(one & fits & up, F.col("one")))
    out = j.withColumn("class", cls).withColumn("way", way.cast("bigint")).where(F.col("class").isNotNull())
    return out.select("fantoir", F.col("voie_c").alias("voie"), "class", "way", *lonlat_cols("c.x", "c.y"), "l", "l_noname")


_C2_STATUS = f"select distinct ({_FANTOIR_TXT.format(k='fantoir')}) as fantoir from fx_status where statut = 5"
_C2_WAYS = ("select osm_id, case when osm_id % 10 = 7 then null else name end as name, hw_class as highway "
            "from fx_way where hw_class is not null")


def c02_inputs(spark: SparkSession, sf: str):
    register(spark, sf)
    groups = missing_streets_fill(_cumul(spark, sf))
    status = spark.sql(_C2_STATUS)
    ways = spark.sql(_C2_WAYS).join(inputs.osm_lines(spark, sf).select("osm_id", "pts"), "osm_id")
    return groups, status, ways


def _sx(y):
    return crs.scale_e(y)


def _sy(y):
    return crs.scale_n(y)


def _geo(x1, y1, x2, y2):
    my = f"(({y1}) + ({y2})) / 2.0"
    return f"sqrt(power((({x2}) - ({x1})) * {_sx(my)}, 2) + power((({y2}) - ({y1})) * {_sy(my)}, 2))"


_SEG_T = ("s.x1", "s.y1", "s.x2", "s.y2")
_PIECES = f"""
select q.*, {_geo('q.x1', 'q.y1', 'q.x2', 'q.y2')} as glen,
  sqrt(cast((q.x2 - q.x1) * (q.x2 - q.x1) + (q.y2 - q.y1) * (q.y2 - q.y1) as double)) as len,
  -(ey2 - ey1) * (x1 - ex1) + (ex2 - ex1) * (y1 - ey1) as hn, -(ey2 - ey1) * (x2 - x1) + (ex2 - ex1) * (y2 - y1) as hd,
  greatest(0.0, case when rd1 > 0 then -rn1 / rd1 end, case when rd2 > 0 then -rn2 / rd2 end,
           case when rd3 > 0 then -rn3 / rd3 end, case when rd4 > 0 then -rn4 / rd4 end) as r_lo,
  least(1.0, case when rd1 < 0 then -rn1 / rd1 end, case when rd2 < 0 then -rn2 / rd2 end,
        case when rd3 < 0 then -rn3 / rd3 end, case when rd4 < 0 then -rn4 / rd4 end) as r_hi,
  (rd1 = 0 and rn1 < 0) or (rd2 = 0 and rn2 < 0) or (rd3 = 0 and rn3 < 0) or (rd4 = 0 and rn4 < 0) as r_bad,
  case when da = 0 then (case when dc <= 0 then 0.0 end) when dd < 0 then null
       else greatest(0.0, (-db - sqrt(greatest(dd, 0))) / (2 * da)) end as d_lo,
  case when da = 0 then (case when dc <= 0 then 1.0 end) when dd < 0 then null
       else least(1.0, (-db + sqrt(greatest(dd, 0))) / (2 * da)) end as d_hi
from (select z.*,
        ax * ux + ay * uy as rn1, vx * ux + vy * uy as rd1,
        (ex2 - x1) * ux + (ey2 - y1) * uy as rn2, -(vx * ux + vy * uy) as rd2,
        20.0 - (ax * (-uy / ul) + ay * (ux / ul)) as rn3, -(vx * (-uy / ul) + vy * (ux / ul)) as rd3,
        20.0 + (ax * (-uy / ul) + ay * (ux / ul)) as rn4, (vx * (-uy / ul) + vy * (ux / ul)) as rd4,
        vx * vx + vy * vy as da, 2 * (vx * ax + vy * ay) as db, ax * ax + ay * ay - 400.0 as dc,
        (2 * (vx * ax + vy * ay)) * (2 * (vx * ax + vy * ay)) - 4 * (vx * vx + vy * vy) * (ax * ax + ay * ay - 400.0) as dd
      from (select pr.fantoir, pr.voie, pr.noname, s.osm_id, s.seg, s.x1, s.y1, s.x2, s.y2, e.n, e.ex1, e.ey1, e.ex2, e.ey2,
                   e.ex2 - e.ex1 as ux, e.ey2 - e.ey1 as uy,
                   sqrt(cast((e.ex2 - e.ex1) * (e.ex2 - e.ex1) + (e.ey2 - e.ey1) * (e.ey2 - e.ey1) as double)) as ul,
                   s.x1 - e.ex1 as ax, s.y1 - e.ey1 as ay, s.x2 - s.x1 as vx, s.y2 - s.y1 as vy
            from prn pr join fx_segment s on s.osm_id = pr.osm_id
            join he e on e.fantoir = pr.fantoir and e.voie = pr.voie) z) q"""
_PERSEG = """
select fantoir, voie, noname, osm_id, seg, n, max(len) as len, max(glen) as glen,
  greatest(0.0, max(case when hd > 0 then -hn / hd end)) as h_lo, least(1.0, min(case when hd < 0 then -hn / hd end)) as h_hi,
  bool_or(hd = 0 and hn < 0) as h_bad,
  min(case when not r_bad and r_lo <= r_hi then r_lo end) as rlo, max(case when not r_bad and r_lo <= r_hi then r_hi end) as rhi,
  min(case when d_lo <= d_hi then d_lo end) as dlo, max(case when d_lo <= d_hi then d_hi end) as dhi
from pcs group by fantoir, voie, noname, osm_id, seg, n"""
_FRAC = """
select *, case when n >= 3 and not h_bad and h_hi > h_lo then h_hi - h_lo else 0.0 end as fh,
  coalesce(greatest(greatest(rhi, dhi, case when n >= 3 and not h_bad and h_lo <= h_hi then h_hi end)
           - least(rlo, dlo, case when n >= 3 and not h_bad and h_lo <= h_hi then h_lo end), 0.0), 0.0) as fb
from pseg"""
_LONG = """
select fantoir, voie, g from (select a.fantoir, a.voie, {g} as g,
  row_number() over (partition by a.fantoir, a.voie order by (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) desc, {g} desc) as rn
  from {t} a join {t} b on a.fantoir = b.fantoir and a.voie = b.voie {w}) z where rn = 1"""
_C2_CTES = HULL_CTES + (
    ("hc", "select fantoir, voie, count(*) as nverts, avg(x) as cx, avg(y) as cy from hv group by fantoir, voie"),
    ("ho", "select hv.*, hc.nverts as n, row_number() over (partition by hv.fantoir, hv.voie order by "
           "atan2(hv.y - hc.cy, hv.x - hc.cx)) as i from hv join hc on hc.fantoir = hv.fantoir and hc.voie = hv.voie"),
    ("he", "select a.fantoir, a.voie, a.n, a.x as ex1, a.y as ey1, b.x as ex2, b.y as ey2 from ho a join ho b "
           "on a.fantoir = b.fantoir and a.voie = b.voie and b.i = (a.i % a.n) + 1"),
    ("st", _C2_STATUS), ("wy", _C2_WAYS),
    ("grp", f"select g.fantoir, g.voie, g.nb, hc.nverts from g join hc on hc.fantoir = g.fantoir and hc.voie = g.voie "
            f"where hc.nverts >= 2 and g.fantoir not in (select fantoir from st)"),
    ("gb", "select fantoir, voie, min(x) as bx0, min(y) as by0, max(x) as bx1, max(y) as by1 from hv group by fantoir, voie"),
    ("pr", f"""select distinct g.fantoir, g.voie, s.osm_id from grp g join gb b on b.fantoir = g.fantoir and b.voie = g.voie
      join fx_segment s on least(s.x1, s.x2) <= b.bx1 + 20 and greatest(s.x1, s.x2) >= b.bx0 - 20
                       and least(s.y1, s.y2) <= b.by1 + 20 and greatest(s.y1, s.y2) >= b.by0 - 20
      join wy on wy.osm_id = s.osm_id
      where exists (select 1 from he e where e.fantoir = g.fantoir and e.voie = g.voie
                    and {G.seg_seg_within(('e.ex1', 'e.ey1', 'e.ex2', 'e.ey2'), _SEG_T, '20.0')})
         or (select count(*) from he e where e.fantoir = g.fantoir and e.voie = g.voie
             and ((e.ey1 > s.y1) <> (e.ey2 > s.y1))
             and ((e.ex2 - e.ex1) * (s.y1 - e.ey1) - (s.x1 - e.ex1) * (e.ey2 - e.ey1)) * sign(e.ey2 - e.ey1) > 0) % 2 = 1"""),
    ("prn", "select pr.*, wy.name, wy.name is null as noname from pr join wy on wy.osm_id = pr.osm_id"),
    ("ag", """select fantoir, voie, string_agg(cast(osm_id as string), ',' order by cast(osm_id as string)) as id,
      string_agg(case when name is null then cast(osm_id as string) end, ',' order by cast(osm_id as string)) as id_noname,
      max(name) as name, string_agg(name, ';' order by name) as names from prn group by fantoir, voie"""),
    ("pcs", _PIECES), ("pseg", _PERSEG), ("fr", _FRAC),
    ("ms", """select fantoir, voie, sum(len) as sl, sum(len * fb) as slb, sum(glen) as sg, sum(glen * fh) as sgh,
      sum(case when noname then len end) as nsl, sum(case when noname then len * fb end) as nslb,
      sum(case when noname then glen end) as nsg, sum(case when noname then glen * fh end) as nsgh
      from fr group by fantoir, voie"""),
    ("wv", "select distinct prn.fantoir, prn.voie, prn.noname, v.osm_id, v.k, v.x, v.y from prn "
           "join fx_vertex v on v.osm_id = prn.osm_id"),
    ("lg", _LONG.format(g=_geo("a.x", "a.y", "b.x", "b.y"), t="hv", w="")),
    ("lw", _LONG.format(g=_geo("a.x", "a.y", "b.x", "b.y"), t="wv", w="")),
    ("ln", _LONG.format(g=_geo("a.x", "a.y", "b.x", "b.y"), t="wv", w="and a.noname and b.noname")),
    ("cen", """select fantoir, voie, case when max(n) >= 3 then sum((ex1 + ex2) * (ex1 * ey2 - ex2 * ey1)) / 6.0 /
                 (sum(ex1 * ey2 - ex2 * ey1) / 2.0) else (min(ex1) + max(ex1)) / 2.0 end as x,
               case when max(n) >= 3 then sum((ey1 + ey2) * (ex1 * ey2 - ex2 * ey1)) / 6.0 /
                 (sum(ex1 * ey2 - ex2 * ey1) / 2.0) else (min(ey1) + max(ey1)) / 2.0 end as y
               from he group by fantoir, voie"""),
    ("fin", """select g.fantoir, replace(g.voie, '"', '') as voie_c, ag.id, ag.id_noname, ag.name,
      replace(ag.names, '"', '') as names_c, ms.slb / ms.sl as l, ms.sg - ms.sgh as l2,
      ms.nslb / ms.nsl as l_noname, ms.nsg - ms.nsgh as l2_noname, lg.g as l_geom, lw.g as l_ways, ln.g as l_ways_noname,
      cen.x as cx, cen.y as cy
      from grp g left join ag on ag.fantoir = g.fantoir and ag.voie = g.voie
      left join ms on ms.fantoir = g.fantoir and ms.voie = g.voie
      join lg on lg.fantoir = g.fantoir and lg.voie = g.voie
      left join lw on lw.fantoir = g.fantoir and lw.voie = g.voie
      left join ln on ln.fantoir = g.fantoir and ln.voie = g.voie
      join cen on cen.fantoir = g.fantoir and cen.voie = g.voie
      where coalesce(ag.name, '') <> g.voie"""),
    ("cls", """select *,
      (id_noname is not null and id_noname not like '%,%' and (l_geom - l_ways_noname < 100)
        and ((l_noname > 0.5 and l2_noname < 100) or l_noname > 0.75) and upper(voie_c) <> voie_c) as c_nn,
      (id is not null and id not like '%,%' and (l_geom - l_ways < 100)
        and ((l > 0.5 and l2 < 100) or l > 0.75) and upper(voie_c) <> voie_c) as c_one
      from fin"""),
)


@query("c02_street_name_check", f"""
select fantoir, voie_c as voie, class, cast(way as bigint) as way, {_lonlat_sql('cx', 'cy')} from (
  select *, case when id is null then 33 when c_nn then 32 when c_one and names_c is null then 32
                 when c_one and names_c is not null then 31
                 when regexp_matches(names_c, replace(replace(voie_c, '(', ''), ')', ''), 'i') then null else 30 end as class,
            case when id is null then null when c_nn then id_noname when c_one then id end as way
  from cls) z where class is not null""", _C2_CTES)
def c02(spark: SparkSession, sf: str) -> DataFrame:
    return street_name_check(*c02_inputs(spark, sf))


@query("overlap_ratio", """
select fantoir, voie, round(slb / sl, 6) as l, round(sg - sgh, 4) as l2, round(nslb / nsl, 6) as l_noname, round(nsg - nsgh, 4) as l2_noname
from ms where exists (select 1 from ag where ag.fantoir = ms.fantoir and ag.voie = ms.voie and coalesce(ag.name, '') <> ms.voie)""", _C2_CTES)
def overlap_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """For each street with matched ways, the share of their length near its hull and the ground length outside it."""
    m = street_measures(*c02_inputs(spark, sf)).where("n is not null")
    return m.select("fantoir", "voie", F.round("l", 6).alias("l"), F.round("l2", 4).alias("l2"), F.round("l_noname", 6).alias("l_noname"),
                    F.round("l2_noname", 4).alias("l2_noname"))


@query("classify_street", """
select class, count(*) as n, count(way) as n_way from (
  select case when id is null then 33 when c_nn then 32 when c_one and names_c is null then 32
              when c_one and names_c is not null then 31
              when regexp_matches(names_c, replace(replace(voie_c, '(', ''), ')', ''), 'i') then null else 30 end as class,
         case when id is null then null when c_nn then id_noname when c_one then id end as way
  from cls) z where class is not null group by class""", _C2_CTES)
def classify_street(spark: SparkSession, sf: str) -> DataFrame:
    """C2's classes counted, from the measures alone."""
    r = classify_streets(street_measures(*c02_inputs(spark, sf)))
    return r.groupBy("class").agg(F.count("*").alias("n"), F.count("way").alias("n_way"))
