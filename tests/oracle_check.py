"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from geoqa.plans.fixtures import BASE_TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("GEOQA_STRICT") else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    res = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2),
               duck_s=round(t2 - t1, 2))
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return res
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a != b:
        diff = [r for r in a if r not in set(b)][:3]
        diff2 = [r for r in b if r not in set(a)][:3]
        res.update(ok=False, why=f"values differ; spark-only {diff}; oracle-only {diff2}")
        return res
    res.update(ok=True)
    return res


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    from geoqa.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", 8, extra={"spark.driver.memory": "16g"})
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in sorted(qs.items()):
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, os_.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
