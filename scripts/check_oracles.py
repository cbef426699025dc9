"""Run each registered query in Spark and its SQL oracle in DuckDB; compare.

    python scripts/check_oracles.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the
values (floats rounded to 9 significant digits, timestamps as strings).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tillwise.oracles import oracle_sql  # noqa: E402
from tillwise.plans.registry import queries  # noqa: E402
from tillwise.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return str(v)


def spark_type(t) -> str:
    n = t.simpleString()
    return {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
            "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}.get(
        n, n.upper().replace("ARRAY<STRING>", "VARCHAR[]"))


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    # CHECK_TZ runs the Spark side under another session time zone (results must not change)
    tz = os.environ.get("CHECK_TZ")
    spark = local_session(8, extra={"spark.sql.session.timeZone": tz} if tz else None)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows={len(rows):7d} (no oracle) spark={ts:.1f}s")
            continue
        t0 = time.time()
        cur = con.execute(sqls[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        to = time.time() - t0
        stypes = {f.name: spark_type(f.dataType) for f in df.schema.fields}
        otypes = {d[0]: str(d[1]).upper() for d in cur.description}
        tdiff = {c: (stypes[c], otypes.get(c)) for c in stypes if stypes[c] != otypes.get(c)}
        if tdiff:
            print(f"   types differ {name}: {tdiff}")
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = (len(rows) == len(orows) and sorted(cols) == sorted(ocols) and h1 == h2)
        bad += not ok
        print(f"{name:28s} rows={len(rows):7d}/{len(orows):7d} cols={'ok' if sorted(cols)==sorted(ocols) else (cols, ocols)} "
              f"hash={'ok' if h1 == h2 else 'DIFF'} spark={ts:.1f}s duck={to:.1f}s")
        if not ok and sorted(cols) == sorted(ocols):
            s1, s2 = set(l1), set(l2)
            print("   spark-only:", sorted(s1 - s2)[:3])
            print("   oracle-only:", sorted(s2 - s1)[:3])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
