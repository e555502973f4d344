"""Anomaly reports: the row model, the class catalogue and the sinks
(S7-S10).

A report is a DataFrame with one row per anomaly::

    check STRING, item INT, class INT, subclass INT, dept STRING,
    anomaly_id STRING, lat DOUBLE, lon DOUBLE,
    text ARRAY<STRUCT<lang STRING, value STRING>>,
    osm ARRAY<STRUCT<kind STRING, id BIGINT, tags ARRAY<STRUCT<k, v>>>>,   -- node / way / relation refs
    fixes ARRAY<STRUCT<kind STRING, id BIGINT, tags ARRAY<STRUCT<action, k, v>>>>

The report key is (check, item, class): class ids repeat across checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoqa.session import ship_package

# The class header of every check (check, item, class, tag,
# level, French title, English title), as the source checks publish them.
# Titles with a distance take it from the check's parameter.
CATALOGUE = [
    ("c02_street_name_check", 7170, 30, "highway", 3, "name=* ou route potentiellement manquante à proximité",
     "name=* or possibly missing highway in the area"),
    ("c02_street_name_check", 7170, 31, "highway", 3, "name=* à modifier sur highway ?", "name=* to change on highway ?"),
    ("c02_street_name_check", 7170, 32, "highway", 3, "name=* à ajouter sur highway ?", "name=* to add on highway ?"),
    ("c02_street_name_check", 7170, 33, "highway", 3, "route manquante à proximité ?", "missing highway in the area ?"),
    ("c03_poi_near_building", 7170, 60, "highway", 3, "POI proche d'un bâtiment", "POI near building"),
    ("c04_missing_pharmacy", 7170, 99, "highway", 3, "Pharmacie manquante (SIRENE)", "Missing pharmacy (SIRENE)"),
    ("c05_missing_power_line", 7040, 95, "power", 3, "ligne électrique HT (power=line) manquante à proximité",
     "missing power=line in the area"),
    ("c06_substation_to_import", 8280, 94, "power", 3, "poste de transformation HT/BT à intégrer",
     "power=substation from opendata"),
    ("c07_shifted_admin_vertices", 7170, 40, "boundary", 3, "limite admin décalée ?", "misplaced admin boundary ?"),
    ("c08_shifted_boundary_clusters", 7170, 40, "boundary", 3, "limite admin décalée ?", "misplaced admin boundary ?"),
    ("c09_building_without_road", 7170, 11, "boundary", 3, "route manquante pour accès au bâtiment",
     "no road to access building"),
    ("c10_address_without_road", 7170, 12, "highway", 2, "adresse sans route à {d} m", "adresse without highway within {d} m"),
    ("c11_building_cluster_without_road", 7170, 11, "highway", 2, "bâtiment sans route à {d} m",
     "building without highway within {d} m"),
    ("c12_cadastre_street_without_road", 7170, 13, "highway", 2, "voirie cadastre sans route à {d} m",
     "cadastre, no highway within {d} m"),
    ("c13_unimported_buildings", 7170, 50, "buildings", 3, "bâtiments non importés sur la commune",
     "cadastre buildings not yet imported"),
    ("c14_populated_square_no_road", 7170, 1, "highway", 2, "route potentiellement manquante à proximité",
     "possibly missing highway in the area"),
    ("c14_populated_square_no_road", 7170, 10, "highway", 3, "route potentiellement manquante à proximité",
     "possibly missing highway in the area"),
    ("c15_missing_road_ref", 7170, 2, "highway", 3, "ref=* ou route potentiellement manquante à proximité",
     "ref=* or possibly missing highway in the area"),
    ("c16_missing_lanes_a", 7170, 20, "highway", 3, "lanes=* manquant sur voie avec plus de deux voies dans Route500",
     "lanes=* missing on way with more than 2 lanes in Route500"),
    ("c17_name_equals_ref", 7170, 3, "highway", 3, "ref=*/name=* similaires sur highway", "similar ref=*/name=* on highway"),
    ("c18_missing_road", 7170, 1, "highway", 3, "route potentiellement manquante à proximité (BD Topo IGN)",
     "possibly missing highway in the area (BD Topo IGN)"),
    ("c19_road_ref_or_shift", 7170, 3, "highway", 3, "ref=* manquant ou tracé décalé de la route comparé à la BDTopo IGN",
     "missing ref=* or misaligned road compared to BDTopo IGN"),
    ("c20_most_shifted_vertex", 7170, 4, "highway", 3, "Route fortement décalée par rapport à la BDTopo IGN ou mauvais type de highway=*",
     "Misaligned road compared to BDTopo IGN or bad highway=* type"),
    ("c21_missing_lanes_b", 7170, 20, "highway", 3, "lanes=* manquant sur route à plus de 2 voies (BD Topo)",
     "lanes=* missing on highway with more than 2 lanes (BD Topo)"),
    ("c22_missing_waterway", 7171, 98, "waterway", 3, "(TEST) cours d'eau potentiellement manquant à proximité",
     "(TEST) possibly missing waterway in the area"),
    ("c23_cadastre_name_without_road", 7170, 99, "highway", 3, "(TEST) name=* ou route potentiellement manquante à proximité",
     "(TEST) name=* or possibly missing highway in the area"),
    ("c24_missing_hiking_route", 7170, 95, "highway", 3, "(TEST) Itinéraire de randonnée manquant à proximité (PDIPR)",
     "(TEST) Missing route=hiking in this area"),
    ("c25_missing_path_vertex", 7170, 98, "highway", 3, "(TEST) Route ou chemin manquant (PDIPR)",
     "(TEST) Road or path missing (Hiking routes merge)"),
]
DEFAULT_DISTANCES = {"c10_address_without_road": 200, "c11_building_cluster_without_road": 200,
                     "c12_cadastre_street_without_road": 20}

# Fixed values: (example, resource) of a class text where one is published, by (check, class, language).
CLASS_NOTES = {("c20_most_shifted_vertex", 4, "fr"): (None, "https://geoservices.ign.fr/bdtopo")}


def class_notes(check: str, cls: int, lang: str) -> tuple[str | None, str | None]:
    """(example, resource) of a class text, where it has them."""
    return CLASS_NOTES.get((check, cls, lang), (None, None))


CATALOGUE_SCHEMA = ("check STRING, item INT, class INT, tag STRING, level INT, title_fr STRING, title_en STRING")

REPORT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()), T.StructField("item", T.IntegerType()),
    T.StructField("class", T.IntegerType()), T.StructField("subclass", T.IntegerType()),
    T.StructField("dept", T.StringType()), T.StructField("anomaly_id", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("text", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()),
                                                    T.StructField("value", T.StringType())]))),
    T.StructField("osm", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("id", T.LongType()),
        T.StructField("tags", T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])))]))),
    T.StructField("fixes", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("id", T.LongType()),
        T.StructField("tags", T.ArrayType(T.StructType([
            T.StructField("action", T.StringType()), T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])))]))),
])


def class_catalogue(spark: SparkSession, distances: dict | None = None) -> DataFrame:
    """One row per (check, item, class); fixed size (a few dozen rows),
    so joins against it are broadcast."""
    d = {**DEFAULT_DISTANCES, **(distances or {})}
    rows = [(c, i, k, t, lv, fr.format(d=d.get(c, "")), en.format(d=d.get(c, ""))) for c, i, k, t, lv, fr, en in CATALOGUE]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def to_report(df: DataFrame, check: str, item: int, cls, *, lat: str = "lat", lon: str = "lon",
              dept: Column | None = None, anomaly_id: Column | None = None,
              text_fr: Column | None = None, text_en: Column | None = None,
              osm: list[tuple] = (), fixes: list[tuple] = (), subclass: int = 1) -> DataFrame:
    """Map a check result onto the report row model.

    ``osm``: (kind, id[, [(key, value)]]) of the objects; ``fixes``: (kind, id, [(action, key, value)][,
    condition]).  An object without an id and a fix whose condition fails are left out of the row."""
    texts = [F.struct(F.lit(lang).alias("lang"), c.cast("string").alias("value"))
             for lang, c in (("fr", text_fr), ("en", text_en)) if c is not None]
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"))
    act = lambda a, k, v: F.struct(F.lit(a).alias("action"), F.lit(k).alias("k"), v.cast("string").alias("v"))
    some = lambda parts, kind: F.array(*parts) if parts else F.array().cast(kind)
    ref_tags, fix_tags = (REPORT_SCHEMA[n].dataType.elementType["tags"].dataType for n in ("osm", "fixes"))
    refs = [F.when(i.isNotNull(), F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("id"),
                                           some([pair(*t) for t in (tags[0] if tags else ())], ref_tags).alias("tags"))) for kind, i, *tags in osm]
    fx = [F.when((cond[0] if cond else F.lit(True)) & i.isNotNull(), F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("id"),
                                                                            some([act(*t) for t in tags], fix_tags).alias("tags")))
          for kind, i, tags, *cond in fixes]
    cls_col = cls if isinstance(cls, Column) else F.lit(cls)
    out = df.select(
        F.lit(check).alias("check"), F.lit(item).cast("int").alias("item"), cls_col.cast("int").alias("class"),
        F.lit(subclass).cast("int").alias("subclass"),
        (dept if dept is not None else F.lit(None)).cast("string").alias("dept"),
        (anomaly_id if anomaly_id is not None else F.lit(None)).cast("string").alias("anomaly_id"),
        F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"),
        (F.array(*texts) if texts else F.array().cast(REPORT_SCHEMA["text"].dataType)).alias("text"),
        F.filter(some(refs, REPORT_SCHEMA["osm"].dataType), lambda r: r.isNotNull()).alias("osm"),
        F.filter(some(fx, REPORT_SCHEMA["fixes"].dataType), lambda r: r.isNotNull()).alias("fixes"))
    return out


def _of_kind(kind: str):
    return lambda o: o["kind"] == kind


def _xml_rows(report: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Report rows in the element layout of the XML sink (``_`` = attribute);
    ``keep`` columns stay as they are (partition keys)."""
    return report.select(
        *[F.col(k) for k in keep],
        F.col("class").alias("_class"), F.col("subclass").alias("_subclass"),
        F.struct(F.col("anomaly_id").alias("_id")).alias("infos"),
        F.struct(F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).alias("location"),
        F.transform("text", lambda t: F.struct(t["lang"].alias("_lang"), t["value"].alias("_value"))).alias("text"),
        *[F.transform(F.filter("osm", _of_kind(k)), lambda o: F.struct(o["id"].alias("_id"), F.transform(
            o["tags"], lambda t: F.struct(t["k"].alias("_k"), t["v"].alias("_v"))).alias("tag"))).alias(k) for k in ("node", "way", "relation")],
        F.when(F.size("fixes") > 0, F.struct(F.transform("fixes", lambda f: F.struct(*[
            F.when(f["kind"] == k, F.struct(f["id"].alias("_id"), F.transform(f["tags"], lambda t: F.struct(
                t["action"].alias("_action"), t["k"].alias("_k"), t["v"].alias("_v"))).alias("tag"))).alias(k)
            for k in ("node", "way", "relation")])).alias("fix"))).alias("fixes"))


def write_report(report: DataFrame, path: str, compression: str = "gzip", by: tuple[str, ...] = (),
                 timestamp: str | None = None) -> None:
    """XML files (root ``analyser``, one ``error`` element per row,
    gzip), written in parallel; ``by`` splits the output into folders per
    key (e.g. class and department).  Escaping is done by the writer.
    ``timestamp`` (UTC, ``YYYY-MM-DDTHH:MM:SSZ``; F15) goes on the root
    element; it is passed in so reruns are reproducible."""
    xml = _xml_rows(report, keep=by)
    root = f'analyser timestamp="{timestamp}"' if timestamp else "analyser"
    w = (xml.write.format("xml").mode("overwrite").option("rootTag", root).option("rowTag", "error")
         .option("compression", compression))
    if by:
        w = w.partitionBy(*by)
    w.save(path)


def write_catalogue(catalogue: DataFrame, path: str, checks: tuple[str, ...] | None = None) -> None:
    """Class header blocks (``class`` elements with ``classtext`` in each
    language) for the checks of a report, as their own small XML table."""
    c = catalogue.where(F.col("check").isin(*checks)) if checks else catalogue
    xml = c.select(F.col("item").alias("_item"), F.col("tag").alias("_tag"), F.col("class").alias("_id"),
                   F.col("level").alias("_level"),
                   F.array(F.struct(F.lit("fr").alias("_lang"), F.col("title_fr").alias("_title")),
                           F.struct(F.lit("en").alias("_lang"), F.col("title_en").alias("_title"))).alias("classtext"))
    (xml.coalesce(1).write.format("xml").mode("overwrite").option("rootTag", "classes").option("rowTag", "class")
        .save(path))


def _class_block(rows: list, notes) -> str:
    """The ``class`` elements of a document, of (check, item, class, tag, level, French title, English title)."""
    from xml.sax.saxutils import quoteattr
    out = []
    for r in rows:
        texts = []
        for lang, title in (("fr", r.title_fr), ("en", r.title_en)):
            more = "".join(f" {k}={quoteattr(v)}" for k, v in zip(("example", "resource"), notes(r.check, r["class"], lang)) if v)
            texts.append(f"      <classtext lang={quoteattr(lang)} title={quoteattr(title)}{more}/>")
        head = f'    <class item="{r["item"]}" tag={quoteattr(r.tag)} id="{r["class"]}" level="{r.level}">'
        out.append("\n".join([head, *texts, "    </class>"]))
    return "\n".join(out)


def write_document(report: DataFrame, catalogue: DataFrame, path: str, checks: tuple[str, ...], timestamp: str | None = None,
                   compression: str = "gzip", notes=class_notes) -> None:
    """S7 + S10: a report as whole documents: root, the class blocks of ``checks``, then the rows.

    Every part file is a document of its own, so they are written in parallel and committed together by
    Spark's writer, and each can be published alone; the first one exists without rows, too.  The class blocks
    come from the catalogue (fixed size), with the example and the resource of a class where ``notes`` has them."""
    classes = catalogue.where(F.col("check").isin(*checks)).orderBy("item", "class", "check").collect()
    root = f' timestamp="{timestamp}"' if timestamp else ""
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<analysers{root}>\n  <analyser{root}>\n{_class_block(classes, notes)}'
    tail = "  </analyser>\n</analysers>"
    xml = _xml_rows(report)
    rows = xml.select(F.to_xml(F.struct(*[F.col(c) for c in xml.columns]), {"rowTag": "error"}).alias("value"))
    first = report.sparkSession.createDataFrame([(None,)], "value string").coalesce(1)  # a first part, also without rows

    def document(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        line = lambda t: pa.RecordBatch.from_arrays([pa.array([t], pa.string())], ["value"])
        begun = TaskContext.get().partitionId() == 0
        if begun:
            yield line(head)
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            if not begun and b.num_rows:
                begun = True
                yield line(head)
            yield b
        if begun:
            yield line(tail)

    ship_package(report.sparkSession)
    first.union(rows).mapInArrow(document, "value string").write.mode("overwrite").option("compression", compression).text(path)


_CLASS_SCHEMA = ("_item INT, _tag STRING, _id INT, _level INT, classtext ARRAY<STRUCT<_lang: STRING, _title: STRING, _example: STRING, _resource: STRING>>")


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """The class blocks of documents: item, class, tag, level and by language title, example, resource."""
    c = spark.read.format("xml").option("rowTag", "class").schema(_CLASS_SCHEMA).load(path)
    text = lambda lang, k: F.expr(f"element_at(filter(classtext, t -> t._lang = '{lang}'), 1)._{k}").alias(f"{k}_{lang}")
    return c.select(F.col("_item").alias("item"), F.col("_id").alias("class"), F.col("_tag").alias("tag"), F.col("_level").alias("level"),
                    *[text(lang, k) for lang in ("fr", "en") for k in ("title", "example", "resource")])


def read_report(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read an XML report back (attributes keep their ``_`` prefix).  Pass
    ``schema`` when the report may be empty (nothing to infer from)."""
    r = spark.read.format("xml").option("rowTag", "error")
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def report_integrity(report: DataFrame) -> DataFrame:
    """Per (check, class): rows, rows without a location, locations out
    of range, texts that are blank, duplicated locations."""
    bad_loc = F.col("lat").isNull() | F.col("lon").isNull()
    out_range = (F.abs("lat") > 90) | (F.abs("lon") > 180)
    blank_text = F.exists("text", lambda t: F.coalesce(F.trim(t["value"]), F.lit("")) == "")
    per_loc = report.groupBy("check", "class", "lat", "lon").agg(F.count("*").alias("n"))
    dups = per_loc.groupBy("check", "class").agg(F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("dup_locations"))
    base = report.groupBy("check", "class").agg(
        F.count("*").alias("rows"), F.sum(bad_loc.cast("int")).alias("no_location"),
        F.sum(F.coalesce(out_range, F.lit(False)).cast("int")).alias("out_of_range"),
        F.sum(blank_text.cast("int")).alias("blank_text"))
    return base.join(dups, ["check", "class"]).select(
        "check", "class", "rows", F.col("no_location").cast("bigint").alias("no_location"),
        F.col("out_of_range").cast("bigint").alias("out_of_range"), F.col("blank_text").cast("bigint").alias("blank_text"),
        F.col("dup_locations").cast("bigint").alias("dup_locations"))
