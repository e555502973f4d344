"""Inputs that used to be refused, lost or to end a job."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from geoqa.functions import crs
from geoqa.functions import text as T
from geoqa.operators import cluster as CL
from geoqa.operators import sjoin as SJ
from geoqa.operators.sjoin import Ground, Point, Polygon, Segment
from geoqa.plans.checks_street import missing_streets_fill
from geoqa.sources import readers as R


def ring(*pts):
    return [(float(x), float(y)) for x, y in pts] + [(float(pts[0][0]), float(pts[0][1]))]


RINGS = "id long, rings array<array<struct<x: double, y: double>>>"


def boxed(df):
    from geoqa.functions import geom as G
    for name, e in zip(("xmin", "ymin", "xmax", "ymax"), G.rings_bbox("rings")):
        df = df.withColumn(name, F.expr(e))
    return df.withColumn("x", F.expr("rings[0][0].x")).withColumn("y", F.expr("rings[0][0].y"))


def test_polygon_distances(spark):
    tri = [ring((0, 0), (100, 0), (0, 100)), ring((10, 10), (20, 10), (10, 20))]
    p = boxed(spark.createDataFrame([(1, tri)], RINGS)).drop("x", "y")
    shape = Polygon("rings", ("xmin", "ymin", "xmax", "ymax"))
    pts = spark.createDataFrame([(1, 90.0, 90.0), (2, 30.0, 30.0), (3, 12.0, 12.0), (4, -3.0, 50.0), (5, 55.0, 52.0)], "pid long, x double, y double")
    near = lambda d: sorted(r.pid for r in SJ.dwithin_join(pts, p, d, right_geom=shape).collect())
    assert near(0) == [2] and near(2) == [2, 3] and near(5) == [2, 3, 4, 5] and near(60) == [1, 2, 3, 4, 5]
    segs = spark.createDataFrame([(1, 90.0, 90.0, 95.0, 95.0), (2, -5.0, 50.0, 120.0, 50.0), (3, 11.0, 11.0, 13.0, 11.0)], "sid long, x1 double, y1 double, x2 double, y2 double")
    meet = lambda d: sorted(r.sid for r in SJ.dwithin_join(segs, p, d, left_geom=Segment(), right_geom=shape).collect())
    assert meet(0) == [2] and meet(1) == [2, 3] and meet(60) == [1, 2, 3]
    other = boxed(spark.createDataFrame([(7, [ring((500, 500), (600, 500), (600, 600)), ring((30, 5), (35, 5), (35, 8))])], RINGS))
    j = SJ.polygons_intersect_join(p, other.select("id", "rings", "xmin", "ymin", "xmax", "ymax"), left_key=("id",), right_key=("id",), left_geom=shape, right_geom=shape)
    assert j.count() == 1  # a later part lies wholly inside


def test_clusters_of_polygons_and_wide_boxes(spark):
    rows = [(1, [ring((0, 0), (300, 0), (300, 300), (0, 300))]), (2, [ring((340, 250), (350, 250), (350, 260))]), (3, [ring((301, -60), (420, -60), (301, -50))]),
            (4, [ring((1000, 0), (1900, 0), (1900, 10))]), (5, [ring((1895, 60), (1899, 60), (1899, 64))]), (6, [ring((1000, 500), (1010, 500), (1010, 510))]),
            (7, [ring((1400, 60), (1403, 60), (1403, 63))])]
    df = boxed(spark.createDataFrame(rows, RINGS)).withColumn("g", F.when(F.col("id") < 4, "a"))
    c = CL.cluster_within(df, 55, box=("xmin", "ymin", "xmax", "ymax"), rings="rings", group_by=("g",))
    assert {r.id: r.cluster_id for r in c.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7}
    boxes = CL.cluster_within(df, 55, box=("xmin", "ymin", "xmax", "ymax"))
    assert {r.id: r.cluster_id for r in boxes.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 4}


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(1, 0, 0, None), (2, 5, 0, None), (3, 0, 0, "a")], "id long, x long, y long, g string")
    assert {r.id: r.cluster_id for r in CL.cluster_within(df, 10, group_by=("g",)).collect()} == {1: 1, 2: 1, 3: 3}
    rows = [("1234A", None, None, None, "BAN", x, y) for x, y in ((0, 0), (9, 0), (0, 9), (3, 3))]
    a = spark.createDataFrame(rows, "fantoir string, voie_cadastre string, voie_autre string, voie_osm string, source string, x long, y long")
    got = missing_streets_fill(a.withColumn("fantoir", F.lit("00012345"))).collect()
    assert [(r.voie, r.nb, r.nverts) for r in got] == [(None, 4, 3)]


def test_ground_radius_at_any_latitude(spark):
    for lat in (0.0, 48.0, 65.0, 84.0):
        e, n = spark.range(1).select(F.expr(crs.merc_x("2.0D")), F.expr(crs.merc_y(f"{lat}D"))).first()
        sx = spark.range(1).select(F.expr(crs.scale_e(repr(n)))).first()[0]
        segs = spark.createDataFrame([(e + 24 / sx, n, e + 24 / sx, n + 1)], "x1 double, y1 double, x2 double, y2 double")
        pt = SJ.with_geo_scales(spark.createDataFrame([(1, e, n)], "id long, x double, y double"), "y")
        for metres, hit in ((25.0, 1), (23.0, 0)):
            geo = SJ.geo_pt_seg_within("l.x", "l.y", ("r.x1", "r.y1", "r.x2", "r.y2"), metres, scales=SJ.L_SCALES)
            got = SJ.dwithin_join(pt, segs, Ground(metres), left_geom=Point(), residual=geo)
            assert got.count() == hit and got.columns == pt.columns + segs.columns


def test_names_that_are_no_patterns(spark):
    df = spark.createDataFrame([("Rue * du Port", "rue *"), ("Rue [bis", "rue [bis"), ("Rue du Lac", "rue.du"), ("x", "+"), (None, "*")], "t string, p string")
    assert [r.m for r in df.select(T.matches_ci("t", "p").alias("m")).collect()] == [True, True, True, False, None]


def test_json_objects_with_braces(spark, tmp_path):
    f = tmp_path / "dump.json"
    f.write_text('{"lat":1.5,"lon":2.5,"p":{"a":1}}{"lat":2.5,"lon":3.5,"name":"x } { y"} \n {"p":{"q":{"r":"}"}},"lat":3.5,"lon":1}{"lat":4.5,"lon":0}\n')
    got = R.load_json_points(spark, str(f), "lat DOUBLE, lon DOUBLE, name STRING").collect()
    assert sorted((r.lat, r.lon, r.name) for r in got) == [(1.5, 2.5, None), (2.5, 3.5, "x } { y"), (3.5, 1.0, None), (4.5, 0.0, None)]


def test_every_geojson_geometry(spark, tmp_path):
    sq = [[0, 0], [1, 0], [1, 1], [0, 0]]
    geoms = [{"type": "Point", "coordinates": [1, 2, 9]}, {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]},
             {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3], [4, 4]]]}, {"type": "Polygon", "coordinates": [sq]},
             {"type": "MultiPolygon", "coordinates": [[sq], [sq, sq]]}, {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [5, 5]},
             {"type": "MultiPolygon", "coordinates": [[sq]]}]}, None]
    feats = [{"type": "Feature", "properties": {"i": str(i)}, "geometry": g} for i, g in enumerate(geoms)]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, feats)))
    import gzip
    with gzip.open(tmp_path / "all.json.gz", "wt") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f)
    for name, multi in (("lines.json", False), ("all.json.gz", True)):
        got = R.load_geojson(spark, str(tmp_path / name), multiline=multi, dept_from_path=False).collect()
        shape = sorted((r.properties["i"], r.part, len(r.pts) if r.pts else None, [len(x) for x in r.rings] if r.rings else None) for r in got if r.gtype)
        assert shape == [("0", 0, 1, None), ("1", 0, 1, None), ("1", 1, 1, None), ("2", 0, 2, None), ("3", 0, 2, None), ("3", 1, 3, None), ("4", 0, None, [4]),
                         ("5", 0, None, [4]), ("5", 1, None, [4, 4]), ("6", 0, 1, None), ("6", 1, None, [4])]
        assert [r.pts for r in got if not r.gtype] == [None]


def test_large_collection_is_read_by_many_tasks(spark, tmp_path):
    """One document of 4,000 features, on one line or printed over many: the rows of the whole parser, from many splits; gz is one."""
    feats = [{"type": "Feature", "properties": {"id": str(i), "note": 'a "Feature\\" },{"type":' if i % 7 == 0 else "é{[", "n": "x" * (i % 50)},
              "geometry": None if i % 11 == 0 else {"type": "Point", "coordinates": [2.0 + i / 10_000, 48.0]}} for i in range(4000)]
    doc = {"type": "FeatureCollection", "name": "Feature list", "features": feats, "bbox": [2, 48, 3, 49]}
    for name, text in (("one", json.dumps(doc)), ("lines", "\ufeff" + json.dumps(doc, indent=1, ensure_ascii=False) + "\n"),
                       ("bare", json.dumps({"type": "FeatureCollection", "features": []})),
                       ("single", json.dumps({"type": "FeatureCollection", "features": feats[:1]}))):
        path = tmp_path / f"{name}.json"
        path.write_text(text, encoding="utf-8")
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        try:
            split = R.load_geojson(spark, str(path), multiline=True, dept_from_path=False)
            got = sorted(split.collect(), key=lambda r: int(r.properties["id"]))
            tasks = split.rdd.getNumPartitions()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        want = text if name != "lines" else text[1:]
        plain = tmp_path / f"{name}-plain.json"
        plain.write_text(want, encoding="utf-8")
        whole = sorted(R.load_geojson(spark, str(plain), multiline=True, dept_from_path=False, whole=True).collect(), key=lambda r: int(r.properties["id"]))
        assert got == whole and len(got) == {"bare": 0, "single": 1}.get(name, 4000)
        assert name not in ("one", "lines") or tasks > 4
    with gzip.open(tmp_path / "packed.json.gz", "wt", encoding="utf-8") as f:
        json.dump(doc, f)
    assert R.load_geojson(spark, str(tmp_path / "packed.json.gz"), multiline=True, dept_from_path=False).count() == 4000


@pytest.mark.parametrize("feats", [
    '{"id": 1, "type": "Feature", "properties": {}, "geometry": null}',                                   # the type is not first
    '{"type": "Feature", "properties": {"kind": "Feature"}, "geometry": null}',                           # the text stands for something else
    '{"type": "Feature", "properties": {}, "geometry": null}, {"id": 2, "type": "Feature", "properties": {}, "geometry": null}',
])
def test_collections_in_another_order_are_read_whole(spark, tmp_path, feats):
    path = tmp_path / "odd.json"
    path.write_text('{"type": "FeatureCollection", "features": [' + feats + "]}")
    with pytest.raises(Exception, match="whole=True"):
        R.load_geojson(spark, str(path), multiline=True, dept_from_path=False).collect()
    assert R.load_geojson(spark, str(path), multiline=True, dept_from_path=False, whole=True).count() == feats.count('"geometry"')


def test_collection_that_is_cut_off_fails(spark, tmp_path):
    path = tmp_path / "cut.json"
    path.write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"a": "b"}, "geom')
    with pytest.raises(Exception):
        R.load_geojson(spark, str(path), multiline=True, dept_from_path=False).collect()


def test_collection_is_written_as_one_document_each(spark, tmp_path):
    """Opening, features in order and closing stay in one file, however the shuffle's partitions are put together."""
    df = spark.range(4000).selectExpr("id", "cast(id % 3 as string) as dept", "array(named_struct('x', id * 1.0D, 'y', 2D), named_struct('x', 3D, 'y', 4D)) as pts")
    df = df.repartition(5).groupBy("id").agg(F.first("dept").alias("dept"), F.first("pts").alias("pts"))
    conf = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100kb"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        R.to_geojson_collections(df, "dept", "id").write.partitionBy("dept").text(str(tmp_path / "c"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for d in range(3):
        files = list((tmp_path / "c" / f"dept={d}").glob("part-*"))
        assert len(files) == 1
        doc = json.loads(files[0].read_text())
        assert [int(f["properties"]["id"]) for f in doc["features"]] == list(range(d, 4000, 3))
    assert R.load_geojson(spark, str(tmp_path / "c"), multiline=True).count() == 4000
