"""Report rows of every check: texts, object references and suggested fixes as published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoqa.plans import checks_attr, checks_cluster, checks_dist, checks_roads, checks_shift, checks_street  # noqa: F401
from geoqa.plans.registry import ORACLES, QUERIES, query
from geoqa.sources import readers as R
from geoqa.sources import report as REP

E = F.expr
WAY, NODE, RELATION = "way", "node", "relation"


def _plain(check: str, item: int, cls: int, **kw) -> Callable[[DataFrame], DataFrame]:
    """A report whose texts, ids and objects are SQL over the check's columns."""
    return lambda df: REP.to_report(df, check, item, cls, **{k: E(v) if isinstance(v, str) else [(kind, E(i)) for kind, i in v] for k, v in kw.items()})


def street_names(df: DataFrame) -> DataFrame:
    """30 and 33 carry the street key; 32 creates the name, 31 changes it and adds the key."""
    way, name = E("case when class in (31, 32) then way end"), F.col("voie")
    return REP.to_report(
        df, "c02_street_name_check", 7170, F.col("class"), anomaly_id=E("case when class in (30, 33) then fantoir end"),
        text_fr=E("format_string('%s (%s)', voie, fantoir)"), osm=[(WAY, way)],
        fixes=[(WAY, way, [("create", "name", name)], E("class = 32")), (WAY, way, [("modify", "name", name)], E("class = 31")),
               (WAY, way, [("create", "ref:FR:FANTOIR", F.col("fantoir"))], E("class = 31"))])


def substations(df: DataFrame) -> DataFrame:
    """The tags of a distribution station, and what the building becomes."""
    way = F.col("osm_id")
    base = [("create", "power", F.lit("substation")), ("create", "substation", F.lit("minor_distribution")), ("create", "voltage", F.lit("20000")),
            ("create", "operator", F.col("operator")), ("create", "source:power", F.col("operator"))]
    more = {"transformer_tower": [("modify", "building", F.lit("transformer_tower"))],
            "street_cabinet": [("modify", "man_made", F.lit("street_cabinet")), ("modify", "utility", F.lit("power")), ("delete", "building", F.lit(None))],
            "building_service": [("create", "building", F.lit("service")), ("create", "service", F.lit("utility"))]}
    return REP.to_report(df, "c06_substation_to_import", 8280, 94, text_fr=E("format_string('surface: %sm²', m2)"), osm=[(WAY, way)],
                         fixes=[(WAY, way, base + tags, F.col("fix") == kind) for kind, tags in more.items()])


def populated_squares(df: DataFrame) -> DataFrame:
    return REP.to_report(df, "c14_populated_square_no_road", 7170, F.col("class"), anomaly_id=F.col("square_id"),
                         text_fr=E("format_string('%s hab. carreau %s', pop_c, square_id)"), text_en=E("format_string('square id %s (pop. %s)', square_id, pop_c)"))


def names_like_refs(df: DataFrame) -> DataFrame:
    way = F.col("osm_id")
    return REP.to_report(df, "c17_name_equals_ref", 7170, 3, text_fr=E("format_string('ref=%s name=%s', ref, name)"), osm=[(WAY, way)],
                         fixes=[(WAY, way, [("delete", "name", F.lit(""))])])


#: check result -> report rows, for every check that publishes a class (C1 feeds C2 and has none).
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "c02_street_name_check": street_names,
    "c03_poi_near_building": _plain("c03_poi_near_building", 7170, 60, text_fr="concat('shop=', shop, ' à ', dist_m, 'm du bâtiment')", osm=[(NODE, "osm_id")]),
    "c04_missing_pharmacy": _plain("c04_missing_pharmacy", 7170, 99, text_fr="text"),
    "c05_missing_power_line": _plain("c05_missing_power_line", 7040, 95, anomaly_id="geohash", text_fr="nom"),
    "c06_substation_to_import": substations,
    "c07_shifted_admin_vertices": _plain("c07_shifted_admin_vertices", 7170, 40, text_fr="concat(dist_m, ' m - ', communes)"),
    "c08_shifted_boundary_clusters": _plain("c08_shifted_boundary_clusters", 7170, 40, text_fr="concat('jusque ', dist_m, ' m - ', text)",
                                            text_en="concat('up to ', dist_m, ' m - ', text)"),
    "c09_building_without_road": _plain("c09_building_without_road", 7170, 11, osm=[(WAY, "osm_id")]),
    "c10_address_without_road": _plain("c10_address_without_road", 7170, 12, dept="cast(dept as string)", text_fr="''", text_en="''"),
    "c11_building_cluster_without_road": _plain("c11_building_cluster_without_road", 7170, 11, dept="cast(dept as string)", text_fr="''", text_en="''"),
    "c12_cadastre_street_without_road": _plain("c12_cadastre_street_without_road", 7170, 13, text_fr="format_string('%s (%s)', nom, replace(cast(fantoir as string), '_', ''))",
                                               text_en="format_string('%s (%s)', nom, replace(cast(fantoir as string), '_', ''))"),
    "c13_unimported_buildings": _plain("c13_unimported_buildings", 7170, 50, osm=[(RELATION, "relation")],
                                       text_fr="format_string('(%s %s)', insee, name)", text_en="format_string('(%s %s)', insee, name)"),
    "c14_populated_square_no_road": populated_squares,
    "c15_missing_road_ref": _plain("c15_missing_road_ref", 7170, 2, text_fr="format_string('%s (id_route500: %s)', refs, ids)"),
    "c16_missing_lanes_a": _plain("c16_missing_lanes_a", 7170, 20, text_fr="format_string('%s (id_route500: %s)', nb_voies, cleabs)"),
    "c17_name_equals_ref": names_like_refs,
    "c18_missing_road": _plain("c18_missing_road", 7170, 1, anomaly_id="cast(cleabs as string)"),
    "c19_road_ref_or_shift": _plain("c19_road_ref_or_shift", 7170, 3, anomaly_id="geohash", text_fr="text"),
    "c20_most_shifted_vertex": _plain("c20_most_shifted_vertex", 7170, 4, anomaly_id="geohash", osm=[(WAY, "osm_id")],
                                      text_fr="concat('Décalage maxi de ', dist_m, 'm : ', replace(coalesce(name, ''), '\"', ''), ' ', coalesce(ref, ''))"),
    "c21_missing_lanes_b": _plain("c21_missing_lanes_b", 7170, 20, osm=[(WAY, "osm_id")], text_fr="text"),
    "c22_missing_waterway": _plain("c22_missing_waterway", 7171, 98, anomaly_id="geohash", text_fr="nom"),
    "c23_cadastre_name_without_road": _plain("c23_cadastre_name_without_road", 7170, 99, anomaly_id="geohash", text_fr="nom"),
    "c24_missing_hiking_route": _plain("c24_missing_hiking_route", 7170, 95, anomaly_id="geohash", text_fr="nom"),
    "c25_missing_path_vertex": _plain("c25_missing_path_vertex", 7170, 98, anomaly_id="geohash"),
}

#: What the oracle expects of some checks: class, French text, first object, fix tags as ``action key=value``.
_EXPECT = {
    "c04_missing_pharmacy": ("99", "text", "''", "''"),
    "c06_substation_to_import": ("94", "'surface: ' || m2 || 'm²'", "'way ' || osm_id", """
        'create power=substation, create substation=minor_distribution, create voltage=20000, create operator=' || operator || ', create source:power=' || operator || ', '
        || case fix when 'transformer_tower' then 'modify building=transformer_tower'
                    when 'street_cabinet' then 'modify man_made=street_cabinet, modify utility=power, delete building='
                    else 'create building=service, create service=utility' end"""),
    "c13_unimported_buildings": ("50", "'(' || insee || ' ' || name || ')'", "'relation ' || relation", "''"),
    "c14_populated_square_no_road": ("class", "pop_c || ' hab. carreau ' || square_id", "''", "''"),
    "c17_name_equals_ref": ("3", "'ref=' || ref || ' name=' || name", "'way ' || osm_id", "'delete name='"),
    "c21_missing_lanes_b": ("20", "text", "'way ' || osm_id", "''"),
}


def _report_oracle() -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS chk, cast({cls} AS int) AS class, lat, lon, {text} AS text_fr, {obj} AS object, {fix} AS fix
FROM ({ORACLES[c]}) q""" for c, (cls, text, obj, fix) in _EXPECT.items())


_SCHEMA = ("_class INT, location STRUCT<_lat: DOUBLE, _lon: DOUBLE>, text ARRAY<STRUCT<_lang: STRING, _value: STRING>>, "
           + ", ".join(f"{k} ARRAY<STRUCT<_id: BIGINT>>" for k in (NODE, WAY, RELATION))
           + ", fixes STRUCT<fix: ARRAY<STRUCT<way: STRUCT<_id: BIGINT, tag: ARRAY<STRUCT<_action: STRING, _k: STRING, _v: STRING>>>>>>, chk STRING")


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Several checks -> report rows -> XML -> read back: class, place, text, object and fix of each row."""
    path = R.scratch_path(spark, "report-rows")
    for c in _EXPECT:
        REP.write_report(REPORTS[c](QUERIES[c](spark, sf)), f"{path}/chk={c}")
    x = REP.read_report(spark, path, schema=_SCHEMA)
    first = F.coalesce(*[F.concat(F.lit(f"{k} "), F.get(F.col(k), F.lit(0))["_id"].cast("string")) for k in (NODE, WAY, RELATION)], F.lit(""))
    tags = F.flatten(F.transform("fixes.fix", lambda f: F.transform(f["way"]["tag"], lambda t: F.concat(
        t["_action"], F.lit(" "), t["_k"], F.lit("="), F.coalesce(t["_v"], F.lit(""))))))
    return x.select(F.col("chk"), F.col("_class").alias("class"), F.col("location._lat").alias("lat"), F.col("location._lon").alias("lon"),
                    F.expr("element_at(filter(text, t -> t._lang = 'fr'), 1)._value").alias("text_fr"), first.alias("object"),
                    F.coalesce(F.array_join(tags, ", "), F.lit("")).alias("fix"))


def _register() -> None:
    query("report_rows")(report_rows)
    ORACLES["report_rows"] = _report_oracle()


_register()
