"""Compare registered Spark queries with their DuckDB oracle text.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Row count, column names and an order-insensitive value hash, as the
driver's correctness gate does; prints the first differing rows on failure.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records):
    return sorted((tuple(repr(_norm(x)) for x in r) for r in records))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def type_diff(sdf, sql, con) -> dict:
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    s = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
    d = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark, name, fn, sql, sf_dir, con, show=5):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), sec=ts)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    sr = rows_of([tuple(r[i] for i in order_s) for r in s_rows])
    dr = rows_of([tuple(r[i] for i in order_d) for r in d_rows])
    types = type_diff(sdf, sql, con)
    ok = sorted(s_cols) == sorted(d_cols) and sr == dr and not types
    out = dict(name=name, ok=ok, rows=len(s_rows), oracle_rows=len(d_rows), sec=round(ts, 2))
    if types:
        out["types"] = types
    if not ok:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
        a, b = set(sr), set(dr)
        out["spark_only"] = sorted(a - b)[:show]
        out["oracle_only"] = sorted(b - a)[:show]
    out["hash"] = hashlib.sha1(repr(sr).encode()).hexdigest()[:10]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as entry
    from ledgerlake.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, oracle.get(name), sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, ok=False, error=repr(e)[:600])
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
