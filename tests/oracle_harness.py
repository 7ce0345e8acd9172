"""Spark-vs-DuckDB comparison in the shape of the driver's correctness gate:
column names, column types, row count and an order-insensitive value multiset.

Usage: python tests/oracle_harness.py [--pandas] [sf_dir] [key ...]
(--pandas compares through toPandas() / DuckDB .df() instead of row objects)
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for v in VIEWS:
        p = f"{sf_dir}/{v}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT", "float": "FLOAT"}


def spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(t, t.upper())


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def pandas_norm(v):
    """str() of the pandas value, NaN/NaT -> NULL (the pandas fetch path)."""
    import pandas as pd
    if v is None or (not isinstance(v, (str, bytes)) and pd.isna(v)):
        return "NULL"
    return repr(float(v)) if isinstance(v, float) else str(v)


def compare(spark, key: str, fn, sql: str | None, sf_dir: str, con, via_pandas: bool = False) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    names = df.columns
    stypes = [spark_type(f.dataType.simpleString()) for f in df.schema.fields]
    if via_pandas:
        srows = [tuple(pandas_norm(x) for x in r) for r in df.toPandas().itertuples(index=False)]
    else:
        srows = [tuple(norm(x) for x in r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"key": key, "spark_rows": len(srows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    dnames = rel.columns
    dtypes = [str(t).upper().replace(" ", "") for t in rel.types]
    if via_pandas:
        drows = [tuple(pandas_norm(x) for x in r) for r in con.sql(sql).df().itertuples(index=False)]
    else:
        drows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
    out["duck_rows"] = len(drows)
    problems = []
    if sorted(names) != sorted(dnames):
        problems.append(f"names spark={names} duck={dnames}")
    else:
        st = dict(zip(names, stypes))
        dtt = dict(zip(dnames, dtypes))
        bad = {n: (st[n], dtt[n]) for n in names if st[n] != dtt[n]}
        if bad:
            problems.append(f"types {bad}")
        order = sorted(names)
        si = [names.index(n) for n in order]
        di = [dnames.index(n) for n in order]
        s_set = sorted(tuple(r[i] for i in si) for r in srows)
        d_set = sorted(tuple(r[i] for i in di) for r in drows)
        if len(s_set) != len(d_set):
            problems.append(f"rowcount spark={len(s_set)} duck={len(d_set)}")
        if s_set != d_set:
            diff_s = [r for r in s_set if r not in set(d_set)][:3]
            diff_d = [r for r in d_set if r not in set(s_set)][:3]
            problems.append(f"values differ; spark-only={diff_s} duck-only={diff_d} cols={order}")
    out["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        out["problems"] = problems
    return out


def main(argv):
    from derivspark.session import get_spark
    import __spark_entry__ as E
    via_pandas = "--pandas" in argv
    argv = [a for a in argv if a != "--pandas"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck_conn(sf_dir)
    results = []
    for k in (keys or sorted(qs)):
        try:
            r = compare(spark, k, qs[k], orc.get(k), sf_dir, con, via_pandas)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": "ERROR", "error": repr(e)[:800]}
        results.append(r)
        print(json.dumps(r), flush=True)
    bad = [r["key"] for r in results if r["status"] in ("MISMATCH", "ERROR")]
    print(json.dumps({"total": len(results), "bad": bad,
                      "rows_only": [r["key"] for r in results if r["status"] == "rows-only"]}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
