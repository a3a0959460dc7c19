"""Run registered queries against their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive value digest
(floats rounded to 9 significant digits, NaN and null kept apart).
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        if math.isinf(v):
            return ("inf", v > 0)
        return float(f"{v:.9g}")
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i].lower() for i in order], sorted(out, key=repr)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}


def types_match(sdf, con, sql) -> list:
    """Columns whose DuckDB type does not map to the Spark type."""
    rel = con.sql(sql)
    duck = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {c.lower(): t for c, t in sdf.dtypes}
    return [(c, t, spark_types.get(c)) for c, t in duck.items() if DUCK_TO_SPARK.get(t, t) != spark_types.get(c)]


def compare(spark, con, key, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t_spark = time.time() - t
    if sql is None:
        return dict(key=key, ok=None, rows=len(srows), spark_s=round(t_spark, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = normalise(scols, srows)
    dc, dr = normalise(dcols, drows)
    type_diff = types_match(sdf, con, sql)
    ok = sc == dc and sr == dr and not type_diff
    info = dict(key=key, ok=ok, rows=len(srows), oracle_rows=len(drows), spark_s=round(t_spark, 2))
    if type_diff:
        info["types"] = type_diff
    if not ok:
        info["cols"] = (sc, dc) if sc != dc else "same"
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        info["diff"] = diff
    return info


def main(argv):
    vanilla = "--vanilla" in argv  # a plain session, as the driver builds it
    argv = [a for a in argv if a != "--vanilla"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from tripspark.session import build_session
    import __spark_entry__ as E

    if vanilla:
        from pyspark.sql import SparkSession

        import os

        spark = (SparkSession.builder.master(os.environ.get("ORACLE_MASTER", "local[*]"))
                 .config("spark.sql.shuffle.partitions", os.environ.get("ORACLE_PARTITIONS", "8"))
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or sorted(qs):
        try:
            info = compare(spark, con, key, qs[key], sqls.get(key), sf_dir)
        except Exception as e:  # report and go on with the next key
            info = dict(key=key, ok=False, error=f"{type(e).__name__}: {str(e)[:600]}")
        bad += info.get("ok") is False
        print(info, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
