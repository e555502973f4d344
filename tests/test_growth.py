"""Plans whose figures must not grow faster than the input."""

from pyspark.sql import functions as F

from geoqa.functions import geom as G
from geoqa.plans import checks_dist, checks_shift, checks_street, inputs, ops_joins, ops_relational

SF = "/root/testdata/sf0.001"


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tags_and_lines_are_never_broadcast(spark):
    plan = physical(ops_relational.ref_normalise(spark, SF))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_lonely_points_stop_at_the_first_thing_found(spark):
    for q in (checks_dist.c12, checks_dist.c23, checks_shift.c19):
        joins = [line for line in logical(q(spark, SF)).splitlines() if "Join" in line and "_cx" in line and "_full" not in line]
        near = [line for line in joins if "6378137" in line or "_sx" in line]
        assert near and all("LeftAnti" in line for line in near)


def test_point_joins_take_cells_of_their_reach(spark):
    assert "/ 64.0" in logical(checks_shift.c19(spark, SF)) and "/ 80.0" in logical(ops_joins.dwithin_pairs(spark, SF))


def test_nearest_vertex_sorts_no_pairs(spark):
    plan = physical(ops_joins.nearest_vertex(spark, SF))
    assert "Window" not in plan and "partial_min(" in plan


def test_street_measures_meet_a_way_once(spark):
    """One join of hulls and whole ways by cells; segments are not joined to hulls again by key."""
    plan = logical(checks_street.overlap_ratio(spark, SF))
    assert plan.count("hrings") and "wsegs" in plan and "seg#" not in plan


def test_street_with_two_centres_goes_as_a_whole(spark):
    centres = spark.createDataFrame([("a", 0.0, 0.0), ("a", 9000.0, 0.0), ("b", 9000.0, 50.0), ("c", 500.0, 500.0)], "fantoir string, x double, y double")
    words = spark.createDataFrame([(k, "RUE", k.upper(), "X") for k in "abc"], "fantoir string, nature_voie string, nom_voie string, mot string")
    lines = spark.createDataFrame([(1, [(-5.0, 3.0), (5.0, 3.0)])], "osm_id long, pts array<struct<x: double, y: double>>")
    house = spark.createDataFrame([("yes", 490, 490, 510, 510)], "highway string, xmin int, ymin int, xmax int, ymax int")
    house = house.withColumn("rings", F.expr(G.box_rings("xmin", "ymin", "xmax", "ymax")))
    out = checks_dist.cadastre_street_without_road(centres, words, lines, house)
    assert [r.fantoir for r in out.collect()] == ["b"]


def test_ways_keep_one_row_each(spark):
    w = inputs.osm_ways(spark, SF)
    assert w.count() == w.select("osm_id").distinct().count() == inputs.osm_lines(spark, SF).count()


def test_most_shifted_vertex_sorts_no_pairs(spark):
    """Rows are compared for the worst vertex of a way only; the nearest road comes by a number a vertex."""
    plan = logical(checks_shift.c20(spark, SF))
    assert plan.count("min_by(") == 1 and "AS _least" in plan
