"""Run catalog queries in Spark and their SQL in DuckDB; compare rows, columns, values.

usage: python tools/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from lacuna import get_session  # noqa: E402
from lacuna.plans import oracle_sql, queries  # noqa: E402
from lacuna.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def _kind(v):
    import datetime
    import decimal
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    if isinstance(v, decimal.Decimal):
        return "decimal"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return "time"
    return type(v).__name__


def type_mismatches(rows, cols, orows, ocols):
    out = {}
    for c in cols:
        i, j = cols.index(c), ocols.index(c)
        a = {_kind(r[i]) for r in rows if r[i] is not None}
        b = {_kind(r[j]) for r in orows if r[j] is not None}
        if a and b and a != b:
            out[c] = (sorted(a), sorted(b))
    return out


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    if os.environ.get("ORACLE_VIA_ENTRY"):
        # as the driver does: a plain session and the entry module loaded by path
        import importlib.util
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        spec = importlib.util.spec_from_file_location("entry_mod", os.path.join(root, "__spark_entry__.py"))
        mod = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(mod)
        global queries, oracle_sql
        queries, oracle_sql = mod.queries, mod.oracle_sql
    else:
        spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows {name}: {len(rows)} rows, {ts:.1f}s (no oracle)")
            continue
        try:
            cur = con.execute(sqls[name])
            orows = cur.fetchall()
            ocols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns {cols} vs {ocols}")
            bad += 1
            continue
        tmis = type_mismatches(rows, cols, orows, ocols)
        if tmis:
            print(f"FAIL {name}: value types differ {tmis}")
            bad += 1
            continue
        h1, l1 = digest(rows, cols)
        h2, l2 = digest(orows, ocols)
        if len(rows) != len(orows) or h1 != h2:
            bad += 1
            diff = sorted(set(l1) ^ set(l2))[:6]
            print(f"FAIL {name}: rows {len(rows)} vs {len(orows)}; sample diff:")
            for d in diff:
                print("   ", "S" if d in l1 else "D", d[:300])
        else:
            print(f"ok   {name}: {len(rows)} rows, {ts:.1f}s")
    print("failures:", bad)


if __name__ == "__main__":
    main()
