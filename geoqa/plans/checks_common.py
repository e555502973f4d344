"""Building blocks shared by the checks: report coordinates, line midpoints
and segments, department areas, and the line-level two-stage match
(whole line within a planar distance AND midpoint within a ground
distance)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import crs
from geoqa.functions import geom as G
from geoqa.functions import lines as LN
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Point, Polygon, Segment
from geoqa.plans import inputs


def lonlat_cols(x: str, y: str, digits: int = 6) -> list:
    """Mercator point -> rounded ``lon, lat`` report columns."""
    return [F.round(F.expr(crs.lon_of(x)), digits).alias("lon"),
            F.round(F.expr(crs.lat_of(y)), digits).alias("lat")]


def lonlat_sql(x: str, y: str, digits: int = 6) -> str:
    return f"round({crs.lon_of(x)}, {digits}) AS lon, round({crs.lat_of(y)}, {digits}) AS lat"


def geohash_col(x: str, y: str) -> F.Column:
    return F.expr(crs.geohash(crs.lon_of(x), crs.lat_of(y), 20)).alias("geohash")


def geohash_sql(x: str, y: str) -> str:
    return f"{crs.geohash_ansi(crs.lon_of(x), crs.lat_of(y), 20)} AS geohash"


def with_midpoint(lines: DataFrame, pts: str = "pts", frac: str = "0.5", x: str = "mx", y: str = "my") -> DataFrame:
    m = lines.withColumn("_m", F.expr(LN.interpolate(pts, frac)))
    return m.withColumn(x, F.col("_m.x")).withColumn(y, F.col("_m.y")).drop("_m")


def line_segments(lines: DataFrame, pts: str = "pts") -> DataFrame:
    """Explode a line column into segment rows (keeps the other columns)."""
    keep = [c for c in lines.columns if c != pts]
    s = lines.select(*keep, F.explode(F.expr(LN.line_to_segments(pts))).alias("_s"))
    return s.select(*keep, F.col("_s.seg").alias("seg"), F.col("_s.x1").alias("x1"), F.col("_s.y1").alias("y1"),
                    F.col("_s.x2").alias("x2"), F.col("_s.y2").alias("y2"))


DEPT_SQL = ("select dept, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax "
            "from fx_commune group by dept")


def departments(spark: SparkSession, sf: str) -> DataFrame:
    """Level-6 areas: the union of the communes of a department (rectangles here)."""
    c = inputs.communes(spark, sf)
    d = c.groupBy("dept").agg(F.min("xmin").alias("dxmin"), F.min("ymin").alias("dymin"),
                              F.max("xmax").alias("dxmax"), F.max("ymax").alias("dymax"))
    return d.withColumn("drings", F.expr(G.box_rings("dxmin", "dymin", "dxmax", "dymax")))


DEPT_POLY = Polygon("drings", ("dxmin", "dymin", "dxmax", "dymax"))


def two_stage_pairs(lines: DataFrame, way_segs: DataFrame, *, line_id: str, way_id: str,
                    coarse: float, fine_m: float, fine_op: str = "<=", residual: str | None = None,
                    pts: str = "pts") -> DataFrame:
    """(line_id, way_id) pairs where the whole line lies within ``coarse``
    Mercator units of the way AND the line's midpoint lies within ``fine_m``
    ground metres of it.

    The midpoint join carries the selective ground test.  Where the midpoint
    itself is within ``coarse`` the whole-line test is implied; the remaining
    pairs meet their segments by id.  ``residual``: extra SQL over ``l.``/``r.``
    columns.
    """
    mids = SJ.with_geo_scales(with_midpoint(lines, pts).drop(pts), "my")
    fine = SJ.geo_pt_seg_within("l.mx", "l.my", ("r.x1", "r.y1", "r.x2", "r.y2"), str(fine_m), fine_op,
                                scales=SJ.L_SCALES)
    if residual:
        fine = f"({fine}) AND ({residual})"
    wid = way_id if way_id not in lines.columns else "w_" + way_id
    pairs = SJ.dwithin_join(mids, way_segs, SJ.Ground(fine_m), left_geom=Point("mx", "my"), residual=fine, right_prefix="w_", distance_col="_pd")
    pairs = pairs.groupBy(F.col(line_id), F.col(wid).alias("_way")).agg(F.min("_pd").alias("_pd"))
    close = pairs.where(F.col("_pd") <= coarse).select(line_id, "_way")
    far = pairs.where(F.col("_pd") > coarse).select(line_id, "_way")
    segs = line_segments(lines, pts).select(F.col(line_id), *[F.col(c).alias(f"_l{c}") for c in ("x1", "y1", "x2", "y2")])
    ways = way_segs.select(F.col(way_id).alias("_way"), *[F.col(c).alias(f"_w{c}") for c in ("x1", "y1", "x2", "y2")])
    near = G.seg_seg_within(("_lx1", "_ly1", "_lx2", "_ly2"), ("_wx1", "_wy1", "_wx2", "_wy2"), str(coarse))
    far = far.join(segs, line_id).join(ways, "_way").where(F.expr(near)).select(line_id, "_way").distinct()
    return close.unionByName(far).withColumnRenamed("_way", way_id)
