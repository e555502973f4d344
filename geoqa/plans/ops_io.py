"""Sources and sinks (S1-S10) as round-trip plans: data derived from the
given tables is written with Spark writers (to a fresh folder under the
session's checkpoint folder), read back with the geoqa readers, and
compared with SQL over the original tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.functions import crs
from geoqa.plans import inputs
from geoqa.plans.checks_attr import c14
from geoqa.plans.checks_roads import _C9_SQL, c09
from geoqa.plans.fixtures import fx
from geoqa.plans.registry import query
from geoqa.plans.sqlkit import cum_sql, interp_sql, seg_sql
from geoqa.sources import readers as R
from geoqa.sources import report as REP


# ---------------------------------------------------------------- S1
@query("scan_features", "select p_partkey, p_size, p_name from part where p_size between 10 and 20")
def scan_features(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet scan with a declared schema; the filter and the projection
    reach the scan (PushedFilters / ReadSchema)."""
    df = R.load_features(spark, f"{sf}/part.parquet",
                         "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE")
    return df.where(F.col("p_size").between(10, 20)).select("p_partkey", "p_size", "p_name")


_MERC = f"round({crs.merc_x('lon')}, 3) AS x, round({crs.merc_y('lat')}, 3) AS y"


# ---------------------------------------------------------------- S2
@query("ingest_json_points", f"select {_MERC} from fx_lonlat")
def ingest_json_points(spark: SparkSession, sf: str) -> DataFrame:
    """Address dump as back-to-back JSON objects (bz2), parsed by splitting
    records on the closing brace."""
    path = R.scratch_path(spark, "json-points")
    pts = fx(spark, sf, "fx_lonlat").select(F.to_json(F.struct("lat", "lon")).alias("value"))
    pts.write.option("compression", "bzip2").option("lineSep", " ").text(path)
    got = R.load_json_points(spark, path)
    return got.select(F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


# ---------------------------------------------------------------- S3
@query("ingest_geojson", """
select cleabs, count(*) as npoints, cast(cleabs % 5 as string) as dept,
       cast(min(case when k = 0 then x end) as double) as x0
from fx_official group by cleabs""")
def ingest_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """GeoJSON features (WGS84) per department folder -> Mercator lines."""
    path = R.scratch_path(spark, "geojson")
    lines = inputs.official_lines(spark, sf).withColumn("dept", (F.col("cleabs") % 5).cast("string"))
    R.to_geojson_lines(lines, "cleabs", keep=("dept",)).write.partitionBy("dept").text(path)
    g = R.load_geojson(spark, path)
    return g.select(F.col("properties")["cleabs"].cast("bigint").alias("cleabs"),
                    F.size("pts").cast("bigint").alias("npoints"), "dept",
                    F.round(F.col("pts")[0]["x"], 3).alias("x0"))


@query("ingest_geojson_collection", """
select cleabs, count(*) as npoints, cast(cleabs % 5 as string) as dept,
       cast(min(case when k = 0 then x end) as double) as x0
from fx_official group by cleabs""")
def ingest_geojson_collection(spark: SparkSession, sf: str) -> DataFrame:
    """A FeatureCollection document per department, read in splits -> Mercator lines."""
    path = R.scratch_path(spark, "geojson-collection")
    lines = inputs.official_lines(spark, sf).withColumn("dept", (F.col("cleabs") % 5).cast("string"))
    R.to_geojson_collections(lines, "dept", "cleabs").write.partitionBy("dept").text(path)
    g = R.load_geojson(spark, path, multiline=True)
    return g.select(F.col("properties")["cleabs"].cast("bigint").alias("cleabs"),
                    F.size("pts").cast("bigint").alias("npoints"), "dept",
                    F.round(F.col("pts")[0]["x"], 3).alias("x0"))


# ---------------------------------------------------------------- G18
@query("drop_third_coordinate", """
select cleabs, count(*) as npoints, cast(min(case when k = 0 then x end) as double) as x0, cast(max(case when k = 0 then y end) as double) as y0
from fx_official group by cleabs""")
def drop_third_coordinate(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose coordinates carry a height, read as plane lines."""
    path = R.scratch_path(spark, "geojson-z")
    flat = R.to_geojson_lines(inputs.official_lines(spark, sf), "cleabs")
    flat.select(F.regexp_replace("value", r"\[(-?[0-9.]+(?:E-?[0-9]+)?),(-?[0-9.]+(?:E-?[0-9]+)?)\]", "[$1,$2,431.5]").alias("value")).write.text(path)
    g = R.load_geojson(spark, path, dept_from_path=False)
    return g.select(F.col("properties")["cleabs"].cast("bigint").alias("cleabs"), F.size("pts").cast("bigint").alias("npoints"),
                    F.round(F.col("pts")[0]["x"], 3).alias("x0"), F.round(F.col("pts")[0]["y"], 3).alias("y0"))


# ---------------------------------------------------------------- S4
@query("ingest_csv_points", f"select id, {_MERC} from fx_lonlat")
def ingest_csv_points(spark: SparkSession, sf: str) -> DataFrame:
    path = R.scratch_path(spark, "csv-points")
    fx(spark, sf, "fx_lonlat").write.option("header", True).csv(path)
    got = R.load_csv_points(spark, path)
    return got.select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


# ---------------------------------------------------------------- S5
@query("materialise_table", _C9_SQL, inputs.HOUSE_CTES)
def materialise_table(spark: SparkSession, sf: str) -> DataFrame:
    """Truncate-and-refill of an intermediate table, partitioned, read back."""
    return R.materialise(c09(spark, sf), R.scratch_path(spark, "c09"), partition_by=("insee",)) \
        .select("osm_id", F.col("insee").cast("int").alias("insee"), "lon", "lat")


@query("scan_bbox", "select id, x, y from fx_address where x between 4000 and 6500 and y between 8000 and 10500")
def scan_bbox(spark: SparkSession, sf: str) -> DataFrame:
    """A feature table laid out along a space-filling curve, scanned with a bounding box."""
    t = R.materialise_spatial(fx(spark, sf, "fx_address").select("id", "x", "y"), R.scratch_path(spark, "address-z"), unit=50.0, files=16)
    return t.where("x between 4000 and 6500 and y between 8000 and 10500")


# ---------------------------------------------------------------- S6
_FRACS = (0.0, 0.25, 0.5, 0.75, 1.0)
_S6_SQL = " union all ".join(
    f"select id as cleabs, cast({f} as double) as f, round(x, 6) as x, round(y, 6) as y from ({interp_sql('o6_cum', repr(f))}) q{i}"
    for i, f in enumerate(_FRACS))


@query("refresh_sample_points", _S6_SQL, (("o6_seg", seg_sql("fx_official", "cleabs")), ("o6_cum", cum_sql("o6_seg"))))
def refresh_sample_points(spark: SparkSession, sf: str) -> DataFrame:
    pts = R.refresh_sample_points(inputs.official_lines(spark, sf), "cleabs", _FRACS, R.scratch_path(spark, "r500pts"))
    return pts.select("cleabs", F.col("f").cast("double").alias("f"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


# ---------------------------------------------------------------- reports
def c14_report(spark: SparkSession, sf: str) -> DataFrame:
    r = c14(spark, sf)
    return REP.to_report(r, "c14_populated_square_no_road", 7170, F.col("class"),
                         anomaly_id=F.col("square_id"),
                         text_fr=F.format_string("%s hab. carreau %s", "pop_c", "square_id"),
                         text_en=F.format_string("square id %s (pop. %s)", "square_id", "pop_c"))


def c09_report(spark: SparkSession, sf: str) -> DataFrame:
    r = c09(spark, sf)
    return REP.to_report(r, "c09_building_without_road", 7170, 11, dept=(F.col("insee") % 5).cast("string"),
                         osm=[("way", F.col("osm_id"))])


#: The part of a report that is read back; declared, since a report without rows has nothing to infer it from.
_ERROR = ("_class INT, infos STRUCT<_id: STRING>, location STRUCT<_lat: DOUBLE, _lon: DOUBLE>, "
          "text ARRAY<STRUCT<_lang: STRING, _value: STRING>>")

_C14_SQL = """select concat_ws('_', cx, cy) as square_id, case when ceil(pop) > 5 then 1 else 10 end as class,
       cast(ceil(pop) as bigint) as pop_c, round(degrees(cast(cx * 500 + 250.0 AS double) / 6378137.0), 6) as lon,
       round(degrees(2 * atan(exp(cast(cy * 500 + 250.0 AS double) / 6378137.0)) - pi() / 2), 6) as lat
from fx_square where highways = 0"""


# ---------------------------------------------------------------- S7
@query("report_xml_roundtrip", """
select class, lat, lon, format('{} hab. carreau {}', pop_c, square_id) as text_fr, square_id as anomaly_id from c14r""",
       (("c14r", _C14_SQL),))
def report_xml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Report -> gzip XML (``analyser`` / ``error`` elements) -> read back."""
    path = R.scratch_path(spark, "report-xml")
    REP.write_report(c14_report(spark, sf), path)
    x = REP.read_report(spark, path, schema=_ERROR)
    return x.select(F.col("_class").cast("int").alias("class"), F.col("location._lat").cast("double").alias("lat"),
                    F.col("location._lon").cast("double").alias("lon"),
                    F.expr("filter(text, t -> t._lang = 'fr')[0]._value").cast("string").alias("text_fr"),
                    F.col("infos._id").cast("string").alias("anomaly_id"))


# ---------------------------------------------------------------- F15
@query("escape_text", """
select class, square_id as anomaly_id, concat('<', square_id, '> & "', pop_c, '" ''hab'' &amp; ]]>') as text_fr from c14r""", (("c14r", _C14_SQL),))
def escape_text(spark: SparkSession, sf: str) -> DataFrame:
    """Texts full of markup characters survive the XML report as they are."""
    path = R.scratch_path(spark, "report-escape")
    said = F.regexp_extract(F.col("text")[0]["value"], "^([0-9]+)", 1)
    text = F.concat(F.lit("<"), "anomaly_id", F.lit('> & "'), said, F.lit("\" 'hab' &amp; ]]>"))
    REP.write_report(c14_report(spark, sf).withColumn("text", F.transform("text", lambda t: F.struct(t["lang"].alias("lang"), text.alias("value")))), path)
    x = REP.read_report(spark, path, schema=_ERROR)
    return x.select(F.col("_class").cast("int").alias("class"), F.col("infos._id").cast("string").alias("anomaly_id"),
                    F.expr("filter(text, t -> t._lang = 'fr')[0]._value").cast("string").alias("text_fr"))


@query("report_document", f"""
select k.tag, k.level, k.title, k.resource, r.class, r.n from (
  select class, count(*) as n from c14r group by class union all select 11, count(*) from ({_C9_SQL}) a) r
join (values {", ".join(f"({k}, '{t}', {lv}, '{fr.replace(chr(39), chr(39) * 2)}', {'null' if not REP.class_notes(c, k, 'fr')[1] else chr(39) + REP.class_notes(c, k, 'fr')[1] + chr(39)})"
                        for c, i, k, t, lv, fr, _en in REP.CATALOGUE if c.startswith(("c09", "c14")))}) as k(class, tag, level, title, resource)
on k.class = r.class""", inputs.HOUSE_CTES + (("c14r", _C14_SQL),))
def report_document(spark: SparkSession, sf: str) -> DataFrame:
    """Reports as whole documents (root, class blocks, rows); classes and rows read back from the same files."""
    path = R.scratch_path(spark, "report-doc")
    checks = ("c09_building_without_road", "c14_populated_square_no_road")
    report = c09_report(spark, sf).unionByName(c14_report(spark, sf))
    REP.write_document(report, REP.class_catalogue(spark), path, checks=checks, timestamp="2026-01-02T03:04:05Z")
    rows = REP.read_report(spark, path, schema="_class INT").groupBy(F.col("_class").alias("class")).agg(F.count("*").alias("n"))
    blocks = REP.read_classes(spark, path).distinct()  # every file has the blocks
    return blocks.join(rows, "class").select("tag", "level", F.col("title_fr").alias("title"), F.col("resource_fr").alias("resource"), "class", "n")


# ---------------------------------------------------------------- S8
@query("report_split", f"""
select 11 as class, cast(insee % 5 as string) as dept, count(*) as n from ({_C9_SQL}) q group by insee % 5""", inputs.HOUSE_CTES)
def report_split(spark: SparkSession, sf: str) -> DataFrame:
    """Report split into one folder per (class, department), counted back."""
    path = R.scratch_path(spark, "report-split")
    REP.write_report(c09_report(spark, sf), path, by=("class", "dept"))
    x = REP.read_report(spark, path, schema="_class INT, _subclass INT, class INT, dept STRING")
    return (x.groupBy(F.col("class").cast("int").alias("class"), F.col("dept").cast("string").alias("dept"))
             .agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- S9
@query("report_integrity", f"""
select chk as "check", class, count(*) as rows, cast(count(*) - count(lat) as bigint) as no_location,
       cast(count(*) filter (where lat not between -90 and 90) as bigint) as out_of_range, cast(sum(blank) as bigint) as blank_text,
       cast(count(*) - count(distinct concat(coalesce(cast(lat as varchar), '?'), '/', lon)) as bigint) as dup_locations
from (select 'c09_building_without_road' as chk, 11 as class, lat, lon, 0 as blank from ({_C9_SQL}) a
      union all select 'c14_populated_square_no_road', class, lat, lon, 0 from c14r
      union all select 'c14_populated_square_no_road', class,
             case cast(split_part(square_id, '_', 1) as int) % 3 when 0 then null when 1 then lat + 100 else lat end, lon,
             case when cast(split_part(square_id, '_', 2) as int) % 2 = 0 then 1 else 0 end from c14r where class = 10) u
group by chk, class""", inputs.HOUSE_CTES + (("c14r", _C14_SQL),))
def report_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Two reports and a second copy of one class with faults: lost and impossible places, blank texts, repeats."""
    c14 = c14_report(spark, sf)
    cell = F.split("anomaly_id", "_")
    col, row = cell[0].cast("int"), cell[1].cast("int")
    faulty = c14.where("class = 10").withColumn("lat", F.when(col % 3 == 0, None).when(col % 3 == 1, F.col("lat") + 100).otherwise(F.col("lat")))
    faulty = faulty.withColumn("text", F.when(row % 2 == 0, F.transform("text", lambda t: F.struct(t["lang"].alias("lang"), F.lit("  ").alias("value"))))
                               .otherwise(F.col("text")))
    return REP.report_integrity(c09_report(spark, sf).unionByName(c14).unionByName(faulty))


# ---------------------------------------------------------------- S10
_CAT_VALUES = ", ".join(f"('{c}', {i}, {k}, {lv}, '{en.replace(chr(39), chr(39) * 2)}')"
                        for c, i, k, _t, lv, _fr, en in REP.CATALOGUE if c.startswith(("c09", "c14")))


@query("class_catalogue", f"""
select c.chk as "check", c.item, c.class, c.level, c.title_en, count(*) as n
from (select 'c09_building_without_road' as chk, 11 as class from ({_C9_SQL}) a
      union all select 'c14_populated_square_no_road', class from c14r) r
join (values {_CAT_VALUES}) as c(chk, item, class, level, title_en) on c.chk = r.chk and c.class = r.class
group by c.chk, c.item, c.class, c.level, c.title_en""", inputs.HOUSE_CTES + (("c14r", _C14_SQL),))
def class_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Reports joined with the class catalogue (fixed size: broadcast)."""
    rep = c09_report(spark, sf).unionByName(c14_report(spark, sf))
    cat = F.broadcast(REP.class_catalogue(spark))
    j = rep.join(cat, ["check", "item", "class"])
    return j.groupBy("check", "item", "class", "level", "title_en").agg(F.count("*").alias("n"))
