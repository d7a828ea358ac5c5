"""Run a registered query in Spark and its oracle SQL in DuckDB, compare order-insensitively.

Usable from pytest and as ``python -m tests.oracle_util [sf_dir] [key ...]``.
"""

from __future__ import annotations

import math
import sys

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def rows(pdf: pd.DataFrame, digits=None):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) or x is pd.NaT else x, digits) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, con, key, fn, sql, sf_dir):
    sp = fn(spark, sf_dir).toPandas()
    dk = con.execute(sql).df()
    res = {"key": key, "spark_rows": len(sp), "duck_rows": len(dk)}
    sc, sr = rows(sp)
    dc, dr = rows(dk)
    res["cols_match"] = sc == dc
    if sc != dc:
        res["spark_cols"], res["duck_cols"] = sc, dc
        return res
    res["exact"] = sr == dr
    res["approx9"] = rows(sp, 9)[1] == rows(dk, 9)[1]
    if not res["exact"]:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["first_diffs"] = diff
    return res


def main(argv):
    from venuelens.session import local_session
    from venuelens.plans.bindings import ORACLE_SQL, QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or sorted(ORACLE_SQL)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, QUERIES[k], ORACLE_SQL[k], sf_dir)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:600]}
        ok = r.get("exact") and r["spark_rows"] == r["duck_rows"]
        bad += not ok
        print(("OK  " if ok else "BAD ") + repr(r)[:1500], flush=True)
    print(f"{len(keys) - bad}/{len(keys)} exact")


if __name__ == "__main__":
    main(sys.argv[1:])
