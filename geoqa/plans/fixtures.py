"""Deterministic test fixtures derived from the given tables.

The same SQL text builds each fixture in Spark (temp views over the parquet
tables) and in DuckDB (common table expressions of an oracle query).  Every
coordinate is integer arithmetic on table keys, so squared distances are
exact in both engines and value hashes agree.  The fixtures grow with the
scale factor of the input tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# Order matters: later fixtures read earlier ones.
FIXTURE_SQL: dict[str, str] = {
    # buildings: rectangles x0,y0 (lower-left), width w, height h
    "fx_building": """
select c_custkey as osm_id, (c_custkey*7919)%19997 as x0, (c_custkey*104729)%20011 as y0,
       6+c_custkey%17 as w, 5+c_custkey%13 as h,
       case when c_custkey%20=0 then 'pedestrian' end as highway from customer""",
    # 4-vertex ways; highway is null for one in five
    "fx_vertex": """
select p_partkey as osm_id, k, (p_partkey*6101)%19997 + k*(20+p_partkey%31) as x,
       (p_partkey*51787)%20011 + k*((p_partkey*7)%41-20) as y,
       case when p_partkey%5=0 then null else 'residential' end as highway, p_name as name,
       concat(substr('ADN',cast(1+p_partkey%3 as int),1),' ',cast(p_size as varchar(9))) as ref
from part cross join (values (0),(1),(2),(3)) as t(k)""",
    # consecutive vertices
    "fx_segment": """
select a.osm_id, a.k as seg, a.x as x1, a.y as y1, b.x as x2, b.y as y2, a.highway, a.name, a.ref
from fx_vertex a join fx_vertex b on a.osm_id=b.osm_id and b.k=a.k+1""",
    # 5 x 5 square communes; dept = column
    "fx_commune": """
select n_nationkey as insee, n_nationkey%5 as dept, (n_nationkey%5)*4003 as xmin,
       cast(floor(n_nationkey/5) as bigint)*4003 as ymin, (n_nationkey%5)*4003+4003 as xmax,
       cast(floor(n_nationkey/5) as bigint)*4003+4003 as ymax,
       case when n_nationkey%3=0 then 'IMAG' else 'VECT' end as cadastre from nation""",
    # address points with a street key
    "fx_address": """
select o_orderkey as id, (o_orderkey*7919)%19997 as x, (o_orderkey*15485863)%20011 as y,
       o_custkey as street, o_orderpriority as source from orders""",
    # shifted copy of two thirds of the ways, with text lane counts
    "fx_official": """
select osm_id as cleabs, k, x+(osm_id*13+k*7)%31-15 as x, y+(osm_id*17+k*11)%29-14 as y,
       cast(1+osm_id%12 as varchar(2)) as nb_voies, replace(ref,' ','') as num_route,
       cast(1+osm_id%6 as varchar(1)) as importance,
       case when osm_id%11=0 then 'Rond-point' when osm_id%29=3 then 'Bretelle' when osm_id%4=1 then 'Route à 1 chaussée'
            else 'Route' end as nature,
       case when osm_id%10=7 then 'En projet' when osm_id%37=4 then null else 'En service' end as etat,
       case when osm_id%5 in (0, 1) then 'PDIPR' end as itineraire
from fx_vertex where osm_id%3<>0""",
    # half of the official lines with four times as many vertices
    "fx_dense": """
select a.cleabs, a.k*4+t.j as k, a.x+(b.x-a.x)*t.j/4.0 as x, a.y+(b.y-a.y)*t.j/4.0 as y
from fx_official a join fx_official b on a.cleabs=b.cleabs and b.k=a.k+1 cross join (values (0),(1),(2),(3)) as t(j)
where a.cleabs%2=0
union all select cleabs, case when cleabs%2=0 then 12 else k end as k, cast(x as double) as x, cast(y as double) as y
from fx_official where cleabs%2=1 or k=3""",
    # shops in or just right of the building with the same number
    "fx_poi": """
select s_suppkey as osm_id, (s_suppkey*7919)%19997+6+s_suppkey%17+s_suppkey%40-10 as x,
       (s_suppkey*104729)%20011+2 as y,
       case when s_suppkey%7=0 then 'kiosk' when s_suppkey%9=0 then null else 'bakery' end as shop
from supplier""",
    # 500-unit census squares with population (three quarters of a person an address: fractions), buildings, highways
    "fx_square": """
select a.cx, a.cy, a.pop, coalesce(b.n,0) as buildings, coalesce(h.n,0) as highways
from (select cast(floor(x/500) as bigint) as cx, cast(floor(y/500) as bigint) as cy, cast(count(*) as double)*0.75 as pop
      from fx_address group by 1,2) a
left join (select cast(floor(x0/500) as bigint) as cx, cast(floor(y0/500) as bigint) as cy, count(*) as n
           from fx_building group by 1,2) b on a.cx=b.cx and a.cy=b.cy
left join (select cast(floor(x/500) as bigint) as cx, cast(floor(y/500) as bigint) as cy, count(*) as n
           from fx_vertex where highway is not null group by 1,2) h on a.cx=h.cx and a.cy=h.cy""",
    # the addresses as WGS84 degrees
    "fx_lonlat": """
select id, 2+cast(x as double)/100000 as lon, 46+cast(y as double)/100000 as lat from fx_address""",
    # four addresses along each way, one street key per way
    "fx_street_address": """
select osm_id as fantoir,
       case when osm_id%13=0 then upper(name) when osm_id%4=0 then name else concat('Rue ',name) end as voie,
       case when osm_id%7=0 then 'CADASTRE' else 'BAN' end as source,
       x+(k*7+osm_id)%19-9 as x, y+(k*5+osm_id)%17-8 as y from fx_vertex""",
    # what contributors said about a street; 5: handled
    "fx_status": """
select p_partkey as fantoir, case when p_partkey%10=3 then 5 else p_partkey%5 end as statut from part""",
    # one row per OSM way with the tags the checks read (NULL = tag absent)
    "fx_way": """
select osm_id, highway,
       case when highway is null then null when osm_id%6=0 then 'motorway' when osm_id%6=1 then 'primary'
            when osm_id%6=2 then 'secondary_link' when osm_id%6=3 then 'residential'
            when osm_id%6=4 then 'tertiary' else 'service' end as hw_class,
       case when osm_id%9=0 then ref else name end as name, ref,
       case when osm_id%3=1 then cast(1+osm_id%4 as varchar(2)) end as lanes,
       case when osm_id%7=2 then concat('n ', substr(ref, 3, 9)) end as old_ref,
       case when osm_id%11=3 then replace(ref, ' ', '-') end as nat_ref,
       case when osm_id%2=0 then 'line' end as power,
       case when osm_id%3=1 then 'stream' end as waterway,
       case when osm_id%4=2 then 'hiking' end as route,
       case when osm_id%13=5 then 'roundabout' end as junction,
       case when osm_id%17=4 then 'private' when osm_id%17=8 then 'no' end as access,
       case when osm_id%4=1 then 'underground' when osm_id%4=3 then 'overhead' end as location
from (select distinct osm_id, highway, name, ref from fx_vertex) v""",
}

_FX_RE = re.compile(r"\bfx_[a-z_]+\b")


def _deps(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_FX_RE.findall(sql)) if n in FIXTURE_SQL]


def needed_fixtures(sql: str) -> list[str]:
    """Fixtures referenced by ``sql`` plus their dependencies, in build order."""
    seen: set[str] = set()

    def visit(name: str):
        if name in seen:
            return
        for d in _deps(FIXTURE_SQL[name]):
            visit(d)
        seen.add(name)

    for n in _deps(sql):
        visit(n)
    return [n for n in FIXTURE_SQL if n in seen]


def with_fixtures(body: str, ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """Prefix ``body`` with the fixture CTEs it needs (for the DuckDB oracle)."""
    text = body + " ".join(s for _, s in ctes)
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in needed_fixtures(text)]
    parts += [f"{n} AS ({s.strip()})" for n, s in ctes]
    if not parts:
        return body.strip()
    recursive = any("USING KEY" in n.upper() for n, _ in ctes)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body.strip()


_REGISTERED: dict[int, str] = {}


def register(spark: SparkSession, sf_dir: str) -> None:
    """Register the base parquet tables and every fixture as temp views."""
    key = id(spark)
    if _REGISTERED.get(key) == sf_dir and spark.catalog.tableExists("fx_street_address"):
        return
    for t in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for name, sql in FIXTURE_SQL.items():
        spark.sql(sql).createOrReplaceTempView(name)
    _REGISTERED[key] = sf_dir


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.table(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.table(name)
