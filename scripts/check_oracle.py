"""Run every registered query in Spark and its oracle in DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [query ...]
Compares row counts, column names and an order-insensitive hash of the values
(columns sorted by name, as the driver does); on a hash mismatch it also reports
whether the values agree within 1e-9 relative.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import importlib.util  # noqa: E402

from stationlens.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def close(a: str, b: str) -> bool:
    fa, fb = a.split("|"), b.split("|")
    if len(fa) != len(fb):
        return False
    for x, y in zip(fa, fb):
        if x == y:
            continue
        try:
            fx, fy = float(x), float(y)
        except ValueError:
            return False
        if not math.isclose(fx, fy, rel_tol=1e-9, abs_tol=1e-12):
            return False
    return True


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    entry = load_entry()
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in sqls:
            print(f"{name:32s} rows={len(srows):7d} (no oracle) {t1 - t0:6.2f}s")
            continue
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        status = "OK"
        if sorted(scols) != sorted(ocols):
            status = f"COLUMNS {sorted(scols)} vs {sorted(ocols)}"
        elif len(srows) != len(orows):
            status = f"ROWS {len(srows)} vs {len(orows)}"
        elif hs != ho:
            status = "CLOSE" if all(close(a, b) for a, b in zip(ls, lo)) else "VALUES"
            if status == "VALUES":
                diffs = [(a, b) for a, b in zip(ls, lo) if a != b][:3]
                status += " " + repr(diffs)
        if status != "OK":
            bad += 1
        print(f"{name:32s} rows={len(srows):7d} {status} {t1 - t0:6.2f}s", flush=True)
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
