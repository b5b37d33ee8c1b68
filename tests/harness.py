"""Differential check: a registered Spark query against its DuckDB SQL on the same tables.

Compares column names (as sets), row counts and the multiset of rows, values compared exactly
after mapping both engines' Python values to one form. Run as a script to check every query:

    python -m tests.harness /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark simple type names and the DuckDB types that hold the same values.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(spark, con, name: str, query, oracle: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    cols = df.columns
    spark_rows = [tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()]
    t1 = time.time()
    res = con.execute(oracle)
    ocols = [d[0] for d in res.description]
    otypes = {d[0]: str(d[1]) for d in res.description}
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    duck_rows = [tuple(_norm(row[i]) for i in order) for row in res.fetchall()]
    out = {"name": name, "spark_sec": round(t1 - t0, 2), "rows": len(spark_rows),
           "oracle_rows": len(duck_rows), "columns_match": sorted(cols) == sorted(ocols)}
    a, b = Counter(spark_rows), Counter(duck_rows)
    out["values_match"] = a == b
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(cols), sorted(ocols)
    if not out["values_match"]:
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    type_diff = {c: (stypes[c], otypes.get(c)) for c in stypes if stypes[c] != otypes.get(c)}
    out["types_match"] = not type_diff
    if type_diff:
        out["type_diff"] = type_diff
    out["ok"] = out["columns_match"] and out["values_match"] and out["types_match"]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from portstar.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    if os.environ.get("PLAIN_SESSION"):
        # a session with Spark's own defaults, as a caller that does not use get_session has
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        if name not in oracle:
            df = queries[name](spark, sf_dir)
            print({"name": name, "rows": df.count(), "oracle": None})
            continue
        try:
            res = compare(spark, con, name, queries[name], oracle[name], sf_dir)
        except Exception as exc:  # report and go on
            res = {"name": name, "ok": False, "error": str(exc)[:400]}
        failed += not res["ok"]
        print(res, flush=True)
    print(f"FAILED {failed}" if failed else "ALL OK")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
