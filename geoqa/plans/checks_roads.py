"""Checks that look for roads missing near other features (C9 ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.functions import lines as LN
from geoqa.operators.sjoin import Point, Polygon, Segment, contains_join, dwithin_join
from geoqa.plans import inputs
from geoqa.plans.checks_common import lonlat_cols, lonlat_sql
from geoqa.plans.registry import query


# ---------------------------------------------------------------- C9
def building_without_road(buildings: DataFrame, communes: DataFrame, highways: DataFrame,
                          dist: float = 300.0, cell: float | None = None) -> DataFrame:
    """7170/11: buildings (centroid in a commune, positive id) with no highway
    within ``dist`` Mercator units of the building's footprint.

    buildings: osm_id, building, rings, bbox; communes: insee, rings, bbox;
    highways: segment rows.  Output: osm_id, insee, lon, lat of the centroid.
    """
    b = (buildings.where((F.col("osm_id") > 0) & F.col("building").isNotNull()).withColumnRenamed("rings", "footprint")
                  .withColumn("c", F.expr(LN.polygon_centroid("footprint"))).withColumn("cx", F.col("c.x")).withColumn("cy", F.col("c.y")))
    inside = contains_join(b, communes.select("insee", "rings", "xmin", "ymin", "xmax", "ymax")
                           .withColumnRenamed("xmin", "cxmin").withColumnRenamed("ymin", "cymin")
                           .withColumnRenamed("xmax", "cxmax").withColumnRenamed("ymax", "cymax"),
                           ("insee",), point=Point("cx", "cy"),
                           polygon=Polygon("rings", ("cxmin", "cymin", "cxmax", "cymax")))
    inside = inside.select("osm_id", "insee", "footprint", "xmin", "ymin", "xmax", "ymax", "cx", "cy")
    lonely = dwithin_join(inside, highways.select("x1", "y1", "x2", "y2"), dist,
                          left_geom=Polygon("footprint", ("xmin", "ymin", "xmax", "ymax")), right_geom=Segment(), how="left_anti",
                          left_key="osm_id", cell=cell)
    return lonely.select("osm_id", "insee", *lonlat_cols("cx", "cy"))


# a road reaches a house if an end of one is within 300 of an edge of the other, or they cross, or an end lies inside
_C9_NEAR = f"""least({inputs.clamp_d2_sql('s.x1', 's.y1', 'e')}, {inputs.clamp_d2_sql('s.x2', 's.y2', 'e')},
  {inputs.clamp_d2_sql('e.x1', 'e.y1', 's')}, {inputs.clamp_d2_sql('e.x2', 'e.y2', 's')}) <= 90000"""
_C9_CROSS = """((s.x2 - s.x1) * (e.y1 - s.y1) - (s.y2 - s.y1) * (e.x1 - s.x1)) * ((s.x2 - s.x1) * (e.y2 - s.y1) - (s.y2 - s.y1) * (e.x2 - s.x1)) < 0
  and ((e.x2 - e.x1) * (s.y1 - e.y1) - (e.y2 - e.y1) * (s.x1 - e.x1)) * ((e.x2 - e.x1) * (s.y2 - e.y1) - (e.y2 - e.y1) * (s.x2 - e.x1)) < 0"""
_C9_SQL = f"""
select hs.osm_id, c.insee, {lonlat_sql('hs.gx', 'hs.gy')}
from hs join hb on hb.osm_id = hs.osm_id
join fx_commune c on hs.gx between c.xmin and c.xmax and hs.gy between c.ymin and c.ymax
where hs.osm_id > 0 and hs.osm_id not in (
  select e.osm_id from hb b join fx_segment s on s.highway is not null
    and least(s.x1, s.x2) <= b.bx1 + 301 and greatest(s.x1, s.x2) >= b.bx0 - 301 and least(s.y1, s.y2) <= b.by1 + 301 and greatest(s.y1, s.y2) >= b.by0 - 301
  join fx_house_e e on e.osm_id = b.osm_id
  where {_C9_NEAR} or ({_C9_CROSS}))
"""


@query("c09_building_without_road", _C9_SQL, inputs.HOUSE_CTES)
def c09(spark: SparkSession, sf: str) -> DataFrame:
    return building_without_road(inputs.house_footprints(spark, sf), inputs.communes(spark, sf),
                                 inputs.highways(spark, sf))
