"""Spark-vs-DuckDB comparison for the registered queries (mirrors the driver's check).

    python tests/harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_con(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("HARNESS_STRICT") == "1"  # compare doubles bit for bit


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if STRICT else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


SPARK_TO_DUCKDB = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                   "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "DateType()": "DATE"}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    dcols = list(rel.columns)
    dtypes = {c: str(t) for c, t in zip(dcols, rel.types)}
    stypes = {f.name: SPARK_TO_DUCKDB.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    drows = rel.fetchall()
    out["oracle_rows"] = len(drows)
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    out["schema_ok"] = sorted(scols) == sorted(dcols) and stypes == dtypes
    if stypes != dtypes:
        out["types"] = {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes)
                        if stypes.get(c) != dtypes.get(c)}
    out["hash_ok"] = hs == hd
    out["status"] = "ok" if (out["schema_ok"] and out["hash_ok"] and len(srows) == len(drows)) else "MISMATCH"
    if out["status"] != "ok":
        out["cols"] = (sorted(scols), sorted(dcols))
        a, b = set(ls), set(ld)
        out["only_spark"] = sorted(a - b)[:5]
        out["only_oracle"] = sorted(b - a)[:5]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from wordtide.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=8)
    if os.environ.get("HARNESS_TZ"):  # e.g. check independence from the session time zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["HARNESS_TZ"])
    con = duckdb_con(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, os_.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": repr(e)[:2000]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
