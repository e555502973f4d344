"""Readers and table writers.

All readers are plain Spark sources with explicit schemas (no inference on
large inputs) and return the column layouts the checks use: points as
``x, y`` (Mercator) plus ``lon, lat`` when read from degrees, lines as
``pts``, polygons as ``rings``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from geoqa.functions import crs
from geoqa.functions import geom as G
from geoqa.session import ensure_checkpoint_dir

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def load_features(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Feature table from Parquet with a declared schema.  Column
    pruning and min/max (bbox) predicate pushdown happen in the scan."""
    return spark.read.schema(schema).parquet(path)


def load_csv_points(spark: SparkSession, path: str, lat: str = "lat", lon: str = "lon",
                    schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header and lat/lon columns -> adds Mercator x, y.

    Without ``schema`` columns are matched by header name (read as text,
    then cast); with one, by position as Spark's CSV reader does."""
    if schema is not None:
        df = spark.read.option("header", True).schema(schema).csv(path)
    else:
        df = spark.read.option("header", True).option("inferSchema", False).csv(path)
        df = df.withColumn(lat, F.col(lat).cast("double")).withColumn(lon, F.col(lon).cast("double"))
        if "id" in df.columns:
            df = df.withColumn("id", F.col("id").cast("bigint"))
    return df.withColumn("x", F.expr(crs.merc_x(lon))).withColumn("y", F.expr(crs.merc_y(lat)))


JSON_POINT = "lat DOUBLE, lon DOUBLE"


def load_json_points(spark: SparkSession, path: str, schema: str = JSON_POINT) -> DataFrame:
    """Address dumps made of JSON objects written back to back
    (``{"lat":..}{"lat":..}``, possibly one huge line, possibly bz2).

    The text source splits records where one object ends and the next begins
    (``}{``; white space between them is allowed), so a file without line
    breaks is still read in parallel splits (bz2 is splittable).  Each piece
    gets back the braces that the split took - nested objects and braces in
    strings are told apart - and is parsed; a piece that is no JSON fails the
    job instead of becoming an empty row."""
    raw = spark.read.option("lineSep", "}{").text(path)
    # white space between two objects, but not inside a string, becomes a mark to split at
    marked = F.regexp_replace("value", r'("(?:[^"\\]|\\.)*")|(?<=\})\s+(?=\{)', "$1\u0001")
    piece = raw.select(F.explode(F.split(marked, "(?<=\\})\u0001(?=\\{)")).alias("p")).select(F.trim(F.translate("p", "\u0001\n\r", "")).alias("p"))
    piece = piece.where("p <> ''").withColumn("p", F.when(F.col("p").startswith("{"), F.col("p")).otherwise(F.concat(F.lit("{"), F.col("p"))))
    bare = F.regexp_replace("p", r'"(?:[^"\\]|\\.)*"', "")
    missing = F.length(F.regexp_replace(bare, "[^{]", "")) - F.length(F.regexp_replace(bare, "[^}]", ""))
    piece = piece.select(F.concat("p", F.repeat(F.lit("}"), F.greatest(missing, F.lit(0)))).alias("p"))
    parsed = piece.select(F.from_json("p", schema, {"mode": "FAILFAST"}).alias("o")).select("o.*")
    if "lat" in parsed.columns and "lon" in parsed.columns:
        parsed = parsed.withColumn("x", F.expr(crs.merc_x("lon"))).withColumn("y", F.expr(crs.merc_y("lat")))
    return parsed


# coordinates are kept as raw JSON text and parsed per geometry type
GEOJSON_FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType()),
        T.StructField("geometries", T.ArrayType(T.StructType([T.StructField("type", T.StringType()),
                                                              T.StructField("coordinates", T.StringType())])))]))])
GEOJSON_COLLECTION = T.StructType([T.StructField("type", T.StringType()),
                                   T.StructField("features", T.ArrayType(GEOJSON_FEATURE))])


def _features_of_collections(spark: SparkSession, path: str) -> DataFrame:
    """The features of FeatureCollection documents, each document read in parallel splits.

    The text source splits records at ``"Feature"``, the value of ``type`` that every feature begins with, so a task
    holds a feature at a time, wherever the lines break (a gz file is one task, bz2 and plain files are many).  A record
    is the rest of one feature and the opening of the next; the parser stops where the feature ends.  Each opening is
    looked at: a document in which other members stand before a feature's type, or that has this very text as the value
    of something else, or that is cut off, fails the job; such documents can be read as a whole.
    """
    raw = spark.read.option("lineSep", '"Feature"').text(path).select(
        F.input_file_name().alias("_file"), F.regexp_replace("value", "^[\\s\ufeff]+", "").alias("_v"))
    opening = r'\{\s*"type"\s*:\s*$'
    head = F.col("_v").startswith("{")  # what stands before the first feature; the other records go on after a type
    ends = F.col("_v").rlike(r"\}\s*$")
    goes_on = F.when(head, F.col("_v").rlike(r"\[\s*" + opening)).otherwise(F.col("_v").rlike(r"\}\s*,\s*" + opening))
    said = F.raise_error(F.concat(F.lit("features that do not begin with their type, read with whole=True: "), F.col("_file")))
    parsed = F.from_json(F.concat(F.lit('{"type":"Feature"'), F.col("_v")), GEOJSON_FEATURE, {"mode": "FAILFAST"})
    feats = raw.select("_file", F.when(~(ends | goes_on), said).when(~head, parsed).alias("f"))
    return feats.where("f IS NOT NULL").select("f.*", "_file")


def load_geojson(spark: SparkSession, path: str, multiline: bool = False,
                 dept_from_path: bool = True, whole: bool = False) -> DataFrame:
    """S3: GeoJSON from WGS84 to Mercator.

    ``multiline=True`` reads FeatureCollection documents, large ones by many tasks
    (:func:`_features_of_collections`; ``whole``: each by one, for any order of
    members); otherwise one Feature per line (splittable).
    Returns props (map), geometry type, ``part``, ``pts`` (LineString / Point)
    or ``rings`` (Polygon) in Mercator, and ``dept`` taken from a ``dept=``
    path segment when present.  Multi-geometries and collections give a row
    for each part; a third coordinate is dropped; a feature without geometry
    keeps its row, and an unknown geometry type fails the job.
    """
    if multiline and whole:
        fc = spark.read.option("multiLine", True).schema(GEOJSON_COLLECTION).json(path)
        feats = fc.select(F.explode("features").alias("f"), F.input_file_name().alias("_file")).select("f.*", "_file")
    elif multiline:
        feats = _features_of_collections(spark, path)
    else:
        feats = spark.read.schema(GEOJSON_FEATURE).json(path).withColumn("_file", F.input_file_name())
    if dept_from_path:
        feats = feats.withColumn("dept", F.regexp_extract("_file", r"dept=([^/]+)", 1))
    def singles(g: str) -> str:
        """The simple geometries of a geometry, as array of (type, coordinates)."""
        return (f"CASE WHEN {g}.type LIKE 'Multi%' THEN transform(from_json({g}.coordinates, 'ARRAY<STRING>'), "
                f"c -> named_struct('type', substr({g}.type, 6), 'coordinates', c)) "
                f"WHEN {g}.type IN ('Point', 'LineString', 'Polygon') THEN array(named_struct('type', {g}.type, 'coordinates', {g}.coordinates)) "
                f"ELSE raise_error(concat('unknown geometry type ', {g}.type)) END")

    parts = (f"CASE WHEN geometry.type IS NULL THEN NULL WHEN geometry.type = 'GeometryCollection' "
             f"THEN flatten(transform(geometry.geometries, g -> {singles('g')})) ELSE {singles('geometry')} END")
    feats = feats.select("properties", *(["dept"] if dept_from_path else []), F.col("geometry.type").alias("gtype"),
                         F.posexplode_outer(F.expr(parts)).alias("part", "_g"))
    coords = F.col("_g.coordinates")
    to_pt = (lambda a: f"named_struct('x', {crs.merc_x(a + '[0]')}, 'y', {crs.merc_y(a + '[1]')})")
    kind = F.col("_g.type")
    feats = (feats.withColumn("_line", F.when(kind == "LineString", F.from_json(coords, "ARRAY<ARRAY<DOUBLE>>")))
                  .withColumn("_poly", F.when(kind == "Polygon", F.from_json(coords, "ARRAY<ARRAY<ARRAY<DOUBLE>>>")))
                  .withColumn("_pt", F.when(kind == "Point", F.from_json(coords, "ARRAY<DOUBLE>"))))
    return feats.select("properties", "gtype", *(["dept"] if dept_from_path else []), "part",
                        F.when(kind == "LineString", F.expr(f"transform(_line, c -> {to_pt('c')})"))
                         .when(kind == "Point", F.expr(f"array({to_pt('_pt')})")).alias("pts"),
                        F.when(kind == "Polygon", F.expr(f"transform(_poly, r -> transform(r, c -> {to_pt('c')}))")).alias("rings"))


def to_geojson_lines(df: DataFrame, id_col: str, pts: str = "pts", props: tuple[str, ...] = (),
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """One GeoJSON LineString Feature per row as JSON text (WGS84), the
    layout ``load_geojson`` reads back; written with ``write.text``
    (``keep`` columns stay alongside, e.g. for ``partitionBy``)."""
    coords = F.expr(f"transform({pts}, p -> array({crs.lon_of('p.x')}, {crs.lat_of('p.y')}))")
    prop_map = F.create_map(F.lit(id_col), F.col(id_col).cast("string"),
                            *[e for c in props for e in (F.lit(c), F.col(c).cast("string"))])
    feat = F.struct(F.lit("Feature").alias("type"), prop_map.alias("properties"),
                    F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates")).alias("geometry"))
    return df.select(*keep, F.to_json(feat).alias("value"))


def to_geojson_collections(df: DataFrame, by: str, id_col: str, pts: str = "pts") -> DataFrame:
    """One FeatureCollection document for each ``by`` as lines of text in order, for ``write.partitionBy(by).text``:
    opening, a Feature a line, closing."""
    w = Window.partitionBy(by).orderBy(id_col)
    lines = to_geojson_lines(df, id_col, pts, keep=(by, id_col)).select(
        by, "value", F.row_number().over(w).alias("_n"), F.lead(F.lit(True)).over(w).isNull().alias("_last"))
    text = F.concat(F.when(F.col("_n") == 1, '{"type":"FeatureCollection","features":[\n').otherwise(","), "value",
                    F.when(F.col("_last"), "\n]}").otherwise(""))
    # opening and closing go with the first and the last Feature: rows of their own might land in files of their own
    return lines.select(by, "_n", text.alias("value")).sortWithinPartitions(by, "_n").select(by, "value")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage
    on a cluster) for tables written and read back by a job."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/geoqa-io/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> DataFrame:
    """Truncate-and-refill of an intermediate table (Parquet), then read
    it back so later stages start from the written copy (cut lineage)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # read with the written schema: an empty result writes no data file to infer from
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_spatial(df: DataFrame, path: str, x: str = "x", y: str = "y", unit: float = 1.0, files: int | None = None) -> DataFrame:
    """S5 for feature tables: written in the order of a Z-shaped curve over ``x, y`` (SQL; a lower-left corner will do).

    Rows are dealt by ranges of the curve and sorted along it within each file, so the minima and
    maxima of files and row groups are small boxes, and a scan with a bbox filter on the same columns
    reads only those that it meets."""
    z = F.expr(G.zorder(x, y, unit))
    dealt = df.repartitionByRange(files, z) if files else df.repartitionByRange(z)
    return materialise(dealt.sortWithinPartitions(z), path)


def refresh_sample_points(lines: DataFrame, id_col: str, fractions=(0.0, 0.25, 0.5, 0.75, 1.0),
                          path: str | None = None) -> DataFrame:
    """Rebuild the sample-point table of a line table: points at fixed
    fractions of each line's length (the source view's definition is not
    published; fixed fractions are this engine's choice)."""
    from geoqa.functions import lines as LN
    arr = F.array(*[F.struct(F.lit(float(f)).alias("f"), F.expr(LN.interpolate("pts", repr(float(f)))).alias("p"))
                    for f in fractions])
    pts = lines.select(id_col, F.explode(arr).alias("s")).select(
        id_col, F.col("s.f").alias("f"), F.col("s.p.x").alias("x"), F.col("s.p.y").alias("y"))
    return materialise(pts, path) if path else pts
