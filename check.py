"""Compare registered queries with their SQL oracles: ``python check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

from tsforge.catalog import load
from tsforge.session import get_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return str([normal(x) for x in v])
    if isinstance(v, dict):
        return str(sorted(v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(normal(row[i]) for i in order) for row in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    queries, oracles = load()
    spark = get_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name, fn in queries.items():
        if names and not any(n == name or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            got = df.collect()
            took = time.time() - start
            cols, rows = rows_of(df.columns, got)
            if name not in oracles:
                print(f"ROWS {name} {len(rows)} {took:.2f}s {rows[:1]}", flush=True)
                continue
            cur = con.execute(oracles[name])
            ocols = [d[0] for d in cur.description]
            otypes = dict(zip(ocols, [str(d[1]) for d in cur.description]))
            want_cols, want = rows_of(ocols, cur.fetchall())
            types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            if cols != want_cols:
                print(f"FAIL {name} columns {cols} != {want_cols}")
                bad += 1
            elif rows != want:
                bad += 1
                diff = [(a, b) for a, b in zip(rows, want) if a != b]
                print(f"FAIL {name} rows {len(rows)} vs {len(want)}, differing {len(diff)}; cols {cols}")
                for a, b in diff[:3]:
                    print("   spark ", a)
                    print("   oracle", b)
            else:
                print(f"OK   {name} {len(rows)} {took:.2f}s {'EMPTY' if not rows else ''}", flush=True)
                pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
                odd = {c: (types[c], otypes[c]) for c in cols if pairs.get(types[c], "?") != otypes[c]}
                if odd:
                    print("     types", odd)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERR  {name} {type(e).__name__} {str(e)[:1500]}", flush=True)
    print("bad", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    os.environ.setdefault("PYTHONWARNINGS", "ignore")
    sys.exit(1 if main() else 0)
