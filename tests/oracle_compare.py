"""Run a named Spark query and its DuckDB oracle on the same tables and compare.

Comparison as the driver does it: row count, column names, and an
order-insensitive hash of the values with columns sorted by name.

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()[:10] if isinstance(v, dt.date) and not isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return str(v)


def canon(columns: list[str], rows: list[tuple]) -> tuple[list[str], str, int]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], h, len(lines)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    s_cols, s_rows = spark_rows(queries()[name](spark, sf_dir))
    t1 = time.time()
    sql = oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    d_cols, d_rows = duck_rows(con, sql)
    sc, sh, sn = canon(s_cols, s_rows)
    dc, dh, dn = canon(d_cols, d_rows)
    out.update(oracle_rows=dn, cols_match=sc == dc, hash_match=sh == dh)
    out["status"] = "ok" if (sn == dn and sc == dc and sh == dh) else "MISMATCH"
    if out["status"] != "ok":
        out["spark_cols"], out["oracle_cols"] = sc, dc
        ss = {"\x1f".join(_norm(r[s_cols.index(c)]) for c in sc) for r in s_rows}
        ds = {"\x1f".join(_norm(r[d_cols.index(c)]) for c in dc) for r in d_rows}
        out["only_spark"] = sorted(ss - ds)[:3]
        out["only_oracle"] = sorted(ds - ss)[:3]
    return out


def main(argv: list[str]) -> int:
    from reelkpi.session import local_session
    from __spark_entry__ import queries

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    import tempfile

    spark = local_session(checkpoint_dir=tempfile.mkdtemp(prefix="reelkpi-checkpoints-"))
    con = duck(sf_dir)
    bad = 0
    for n in names:
        r = compare(spark, sf_dir, n, con)
        bad += r["status"] == "MISMATCH"
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
