"""Run a registered query on Spark and its SQL twin on DuckDB; compare results.

Comparison mirrors the driver's gate: column names sorted, row count, and an
order-insensitive comparison of values.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

from tidemark.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() and abs(v) < 2**53 else float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    opdf = con.execute(sql).df()
    res = {"name": name, "spark_rows": len(spdf), "oracle_rows": len(opdf), "sec": round(t1 - t0, 2)}
    res["cols_match"] = sorted(spdf.columns) == sorted(opdf.columns)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(spdf.columns)
        res["oracle_cols"] = sorted(opdf.columns)
        res["match"] = False
        return res
    a, b = _rows(spdf), _rows(opdf)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = [r for r in a if r not in sb][:3]
        res["only_oracle"] = [r for r in b if r not in sa][:3]
        res["dtypes_spark"] = {c: str(t) for c, t in spdf.dtypes.items()}
        res["dtypes_oracle"] = {c: str(t) for c, t in opdf.dtypes.items()}
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    spark = build_session("local[8]", 8, extra_conf={"spark.sql.session.timeZone": os.environ.get("CHECK_TZ", "UTC")})
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            sdf = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": sdf.count()})
            continue
        r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        bad += not r["match"]
        print(r, flush=True)
    print("MISMATCHES", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
