"""Hand-made edge cases for the geometry expressions (evaluated by Spark)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoqa.functions import crs
from geoqa.functions import geom as G
from geoqa.functions import lines as LN
from geoqa.functions import text as T
from geoqa.operators.hull import monotone_chain


def ev(spark, sql):
    return spark.sql(f"select {sql} as v").collect()[0]["v"]


SQUARE = G.box_rings("0", "0", "10", "10")
HOLED = ("array(array(named_struct('x',0,'y',0), named_struct('x',10,'y',0), named_struct('x',10,'y',10),"
         " named_struct('x',0,'y',10), named_struct('x',0,'y',0)),"
         " array(named_struct('x',3,'y',3), named_struct('x',6,'y',3), named_struct('x',6,'y',6),"
         " named_struct('x',3,'y',6), named_struct('x',3,'y',3)))")


@pytest.mark.parametrize("px,py,covers,contains", [
    (5, 5, True, True),      # inside
    (0, 5, True, False),     # on an edge
    (10, 10, True, False),   # on a vertex
    (11, 5, False, False),   # outside
    (-1, -1, False, False),  # negative coordinates, outside
])
def test_point_in_square(spark, px, py, covers, contains):
    assert ev(spark, G.pt_in_polygon(str(px), str(py), SQUARE, True)) is covers
    assert ev(spark, G.pt_in_polygon(str(px), str(py), SQUARE, False)) is contains


def test_polygon_with_hole(spark):
    assert ev(spark, G.pt_in_polygon("4", "4", HOLED)) is False       # in the hole
    assert ev(spark, G.pt_in_polygon("3", "4", HOLED)) is True        # on the hole's edge = boundary
    assert ev(spark, G.pt_in_polygon("1", "1", HOLED)) is True
    assert ev(spark, LN.area(HOLED)) == pytest.approx(100 - 9)


def test_zero_length_segment(spark):
    assert ev(spark, G.pt_seg_within("3", "4", "0", "0", "0", "0", "5")) is True
    assert ev(spark, G.pt_seg_within("3", "4", "0", "0", "0", "0", "5", "<")) is False
    assert ev(spark, G.pt_seg_d2("3", "4", "0", "0", "0", "0")) == 25


def test_point_segment_distance_exact(spark):
    # distance exactly at the threshold, projection inside the segment
    assert ev(spark, G.pt_seg_within("5", "3", "0", "0", "10", "0", "3")) is True
    assert ev(spark, G.pt_seg_within("5", "3", "0", "0", "10", "0", "3", "<")) is False
    assert ev(spark, G.pt_seg_d2("5", "3", "0", "0", "10", "0")) == pytest.approx(9)


def test_segment_box(spark):
    box = ("0", "0", "4", "4")
    assert ev(spark, G.seg_intersects_box(("-5", "2", "9", "2"), box)) is True   # crosses, endpoints far
    assert ev(spark, G.seg_intersects_box(("-5", "9", "9", "9"), box)) is False
    assert ev(spark, G.seg_box_within(("-5", "9", "9", "9"), box, "5")) is True
    assert ev(spark, G.seg_box_within(("-5", "9", "9", "9"), box, "4")) is False


def test_segments_intersect_collinear(spark):
    assert ev(spark, G.seg_intersects(("0", "0", "4", "0"), ("3", "0", "8", "0"))) is True
    assert ev(spark, G.seg_intersects(("0", "0", "2", "0"), ("3", "0", "8", "0"))) is False


def test_geohash_reference_value(spark):
    assert ev(spark, crs.geohash("-126.0", "48.0", 20)) == "c0w3hf1s70w3hf1s70w3"


def test_mercator_round_trip(spark):
    lon, lat = 2.35, 48.85
    x = ev(spark, crs.merc_x(str(lon)))
    y = ev(spark, crs.merc_y(str(lat)))
    assert ev(spark, crs.lon_of(repr(x))) == pytest.approx(lon, abs=1e-9)
    assert ev(spark, crs.lat_of(repr(y))) == pytest.approx(lat, abs=1e-9)


def test_geodesic_metric_short_range(spark):
    # 0.001 degree of latitude at 45N is about 111.13 m on WGS84
    d = ev(spark, crs.geo_distance("2.0", "45.0", "2.0", "45.001"))
    assert d == pytest.approx(111.13, abs=0.05)


def test_line_measures(spark):
    pts = "array(named_struct('x',0,'y',0), named_struct('x',10,'y',0), named_struct('x',10,'y',10))"
    assert ev(spark, LN.length(pts)) == 20
    mid = ev(spark, LN.interpolate(pts, "0.5"))
    assert (mid["x"], mid["y"]) == (10, 0)
    sub = ev(spark, LN.substring(pts, "0.25", "0.75"))
    assert [(p["x"], p["y"]) for p in sub] == [(5, 0), (10, 0), (10, 5)]
    c = ev(spark, LN.closest_point(pts, "12", "4"))
    assert (c["x"], c["y"]) == (10, 4)


def test_point_on_surface_inside(spark):
    p = ev(spark, LN.point_on_surface(HOLED))
    assert ev(spark, G.pt_in_polygon(repr(p["x"]), repr(p["y"]), HOLED, False)) is True


def test_monotone_chain():
    pts = np.array([[0, 0], [2, 0], [4, 0], [4, 4], [0, 4], [2, 2], [2, 2]], dtype=float)
    hull = monotone_chain(pts)
    assert sorted(map(tuple, hull)) == [(0, 0), (0, 4), (4, 0), (4, 4)]
    assert len(monotone_chain(np.array([[1, 1], [1, 1]], dtype=float))) == 1
    assert len(monotone_chain(np.array([[0, 0], [1, 1], [2, 2]], dtype=float))) == 2


@pytest.mark.parametrize("ref,norm,pretty_in,pretty", [
    ("M 12", "D12", "D12", "D 12"),
    ("a6b", "A6B", "A6B", "A 6B"),
    ("D.12", "D.12", "D.12", "D. 12"),
])
def test_refs(spark, ref, norm, pretty_in, pretty):
    df = spark.createDataFrame([(ref, pretty_in)], "r string, p string")
    row = df.select(T.normalise_ref("r").alias("n"), T.pretty_ref("p").alias("q")).collect()[0]
    assert (row["n"], row["q"]) == (norm, pretty)


def test_name_pattern_as_column(spark):
    df = spark.createDataFrame([("Rue du Moulin", "du moulin"), ("Rue (A)", "Rue A")], "a string, b string")
    got = [r[0] for r in df.select(T.matches_ci("a", T.unbracket("b"))).collect()]
    assert got == [True, False]


def test_rural_name_filter(spark):
    df = spark.createDataFrame([("chemin de la croix",), ("rue des lilas",), ("C.R. 12 des bois",)], "n string")
    got = [r[0] for r in df.select(T.is_rural_name("n")).collect()]
    assert got == [True, False, True]


def test_map_key_missing_null_map(spark):
    df = spark.createDataFrame([({"lanes": "2"},), ({},), (None,)], "tags map<string,string>")
    got = [r[0] for r in df.select(~F.map_contains_key("tags", "lanes")).collect()]
    assert got == [False, True, None]


def test_small_hull_mask_matches_chain():
    from geoqa.operators.hull import SMALL, small_hull_mask
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, SMALL + 1))
        pts = np.unique(rng.integers(0, 5, size=(n, 2)).astype(float), axis=0)  # many collinear/duplicate cases
        k = len(pts)
        P = np.zeros((1, SMALL, 2))
        P[0, :k] = pts
        V = np.zeros((1, SMALL), dtype=bool)
        V[0, :k] = True
        got = {tuple(p) for p in P[0][small_hull_mask(P, V)[0]]}
        assert got == {tuple(p) for p in monotone_chain(pts)}
