"""Run catalogued queries in Spark and their oracle SQL in DuckDB; compare row count, column names,
types and values (order-insensitive).

    python tests/oracle_check.py [/root/testdata/sf0.01] [name ...]

Prints one line per query: OK (exact), APPROX (floats within 1e-9 relative), or the mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from vigil.plans.catalog import REGISTRY  # noqa: E402
from vigil.sources.tables import TABLES, Inputs  # noqa: E402

SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "array<string>": "VARCHAR[]"}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return "COLUMNS", f"spark={spark_cols} duck={duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return "ROWCOUNT", f"spark={len(spark_rows)} duck={len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if s == d:
        return "OK", ""
    worst, first_bad = 0.0, None
    for a, b in zip(s, d):
        for col, x, y in zip(order, a, b):
            if isinstance(x, float) and isinstance(y, float):
                rel = abs(x - y) / max(1.0, abs(x), abs(y))
                worst = max(worst, rel)
                if rel > 1e-9 and first_bad is None:
                    first_bad = (col, x, y)
            elif x != y and first_bad is None:
                first_bad = (col, x, y)
    if first_bad is None:
        return "APPROX", f"max rel diff {worst:.2e}"
    return "VALUES", f"first diff {first_bad}"


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    from vigil.session import get_session
    spark = get_session("local[8]", 8)
    con = duck_connection(sf_dir)
    inp = Inputs(spark, sf_dir)
    todo = names or list(REGISTRY)
    bad = 0
    for name in todo:
        q = REGISTRY[name]
        t0 = time.time()
        try:
            df = q.build(inp)
            spark_cols = df.columns
            spark_types = [f.dataType.simpleString() for f in df.schema.fields]
            spark_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"{name:32s} ROWS-ONLY rows={len(spark_rows)} spark={ts:.1f}s")
            continue
        try:
            cur = con.execute(q.sql)
            duck_cols = [d[0] for d in cur.description]
            duck_types = [str(d[1]) for d in cur.description]
            duck_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        status, detail = compare(spark_rows, spark_cols, duck_rows, duck_cols)
        tmap = dict(zip(duck_cols, duck_types))
        tdiff = [f"{c}:{st}/{tmap.get(c)}" for c, st in zip(spark_cols, spark_types)
                 if SPARK_TO_DUCK.get(st, st).upper() != str(tmap.get(c)).upper()]
        if tdiff:
            detail += f" TYPES {tdiff}"
        if status not in ("OK", "APPROX") or tdiff:
            bad += 1
        print(f"{name:32s} {status:8s} rows={len(spark_rows)} spark={ts:.1f}s {detail}")
    print(f"done: {len(todo)} queries, {bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
