"""Report sink details: root timestamp, escaping, class header table."""

import glob
import gzip
import os

from pyspark.sql import functions as F

from geoqa.sources import report as REP
from geoqa.sources.readers import scratch_path


def test_report_root_timestamp_and_escaping(spark):
    df = spark.createDataFrame([(1, 48.5, 2.25, 'a "b" & <c>')], "id long, lat double, lon double, t string")
    rep = REP.to_report(df, "c09_building_without_road", 7170, 11, text_fr=F.col("t"), osm=[("way", F.col("id"))])
    path = scratch_path(spark, "report-ts")
    REP.write_report(rep, path, timestamp="2026-01-02T03:04:05Z")
    files = [f for f in glob.glob(os.path.join(path.replace("file:", ""), "part-*"))]
    text = "".join(gzip.open(f, "rt").read() for f in files)
    assert 'timestamp="2026-01-02T03:04:05Z"' in text
    assert "&amp;" in text and "&lt;c" in text and "&quot;b&quot;" in text  # '>' may stay in attributes
    back = REP.read_report(spark, path).collect()[0]
    assert back["_class"] == 11 and back["way"]["_id"] == 1  # one element: inferred as a struct


def test_class_catalogue_table(spark):
    path = scratch_path(spark, "catalogue")
    REP.write_catalogue(REP.class_catalogue(spark), path, checks=("c10_address_without_road",))
    rows = spark.read.format("xml").option("rowTag", "class").load(path).collect()
    assert len(rows) == 1 and rows[0]["_id"] == 12
    titles = {t["_lang"]: t["_title"] for t in rows[0]["classtext"]}
    assert titles["en"] == "adresse without highway within 200 m"


def test_street_name_fixes_and_nested_xml(spark):
    from geoqa.plans.reports import REPORTS, street_names
    rows = [("0001", "Rue A", 33, None), ("0002", "Rue B", 32, 7), ("0003", 'Rue "C" & D', 31, 8), ("0004", "Rue E", 30, 9)]
    df = spark.createDataFrame(rows, "fantoir string, voie string, class int, way long").withColumn("lat", F.lit(48.0)).withColumn("lon", F.lit(2.0))
    path = scratch_path(spark, "report-c2")
    REP.write_report(street_names(df).coalesce(1), path)
    text = "".join(gzip.open(f, "rt").read() for f in sorted(glob.glob(os.path.join(path.replace("file:", ""), "part-*"))))
    flat = " ".join(text.split())
    assert flat.count("<fix>") == 3 and flat.count("<fixes>") == 2
    assert '<way id="7"> <tag action="create" k="name" v="Rue B"/> </way>' in flat
    assert 'action="modify" k="name" v="Rue &quot;C&quot; &amp; D"' in flat and 'action="create" k="ref:FR:FANTOIR" v="0003"' in flat
    assert flat.count('<infos id=') == 2
    published = {c for c, *_ in REP.CATALOGUE}
    assert set(REPORTS) == published


def test_documents_of_all_checks(spark):
    """Root, class blocks with resource, rows: each part file is a whole document, read back with its classes."""
    import xml.etree.ElementTree as ET
    checks = tuple(dict.fromkeys(c for c, *_ in REP.CATALOGUE))
    frames = []
    for i, (c, item, cls, *_rest) in enumerate(REP.CATALOGUE):
        df = spark.createDataFrame([(k, 48.5, 2.25, f'{c} "{k}" & <b>') for k in range(i % 3 + 1)], "id long, lat double, lon double, t string")
        frames.append(REP.to_report(df, c, item, cls, text_fr=F.col("t"), osm=[("way", F.col("id"))],
                                    fixes=[("way", F.col("id"), [("create", "name", F.col("t"))])]))
    report = frames[0]
    for f in frames[1:]:
        report = report.unionByName(f)
    path = scratch_path(spark, "documents")
    REP.write_document(report.repartition(3), REP.class_catalogue(spark), path, checks, timestamp="2026-01-02T03:04:05Z")
    seen = 0
    for name in glob.glob(os.path.join(path.replace("file:", ""), "part-*")):
        root = ET.fromstring(gzip.open(name, "rb").read())
        assert root.tag == "analysers" and root.get("timestamp") == "2026-01-02T03:04:05Z"
        body = [e.tag for e in root.find("analyser")]
        n = len(REP.CATALOGUE)
        assert body[:n] == ["class"] * n and set(body[n:]) <= {"error"}
        seen += len(body) - n
    assert seen == report.count()
    back = REP.read_report(spark, path, schema="_class INT, text ARRAY<STRUCT<_lang: STRING, _value: STRING>>")
    got = sorted((r[0], r[1][0]["_value"]) for r in back.collect())
    assert got == sorted((r["class"], r["text"][0]["value"]) for r in report.collect())
    classes = REP.read_classes(spark, path).distinct().collect()
    assert len(classes) == len({(i, k, t, lv, fr, en) for _, i, k, t, lv, fr, en in REP.CATALOGUE})
    noted = [c for c in classes if c.resource_fr]
    assert [(c["class"], c.title_en[:10]) for c in noted] == [(4, "Misaligned")] and noted[0].resource_fr.startswith("https://")
    empty = scratch_path(spark, "documents-empty")
    REP.write_document(report.limit(0).repartition(1), REP.class_catalogue(spark), empty, checks[:1])
    assert REP.read_report(spark, empty, schema="_class INT").count() == 0 and REP.read_classes(spark, empty).count() == 4


def test_report_queries_without_anomalies(spark, monkeypatch):
    """No square without a road: the reports are empty, and so are the results."""
    from geoqa.plans import ops_io
    row = spark.createDataFrame([("1_2", 1, 7, 46.0, 2.0)], "square_id string, class int, pop_c long, lat double, lon double")
    for rows in (row.where("false"), row):
        monkeypatch.setattr(ops_io, "c14", lambda spark, sf, rows=rows: rows)
        whole, escaped = ops_io.report_xml_roundtrip(spark, ""), ops_io.escape_text(spark, "")
        n = rows.count()
        assert [tuple(r) for r in whole.collect()] == [(1, 46.0, 2.0, "7 hab. carreau 1_2", "1_2")] * n
        assert [tuple(r) for r in escaped.collect()] == [(1, "1_2", "<1_2> & \"7\" 'hab' &amp; ]]>")] * n
