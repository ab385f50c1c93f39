"""Run registered queries beside their SQL and compare the rows exactly (doubles by value, order ignored)."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        files = f"{sf_dir}/{t}.parquet"
        files += "/*.parquet" if Path(files).is_dir() else ""
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{files}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return int(v) if v.is_integer() else v
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return v.date().isoformat()
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty text if both agree."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else ("no rows" if not got else "")


if __name__ == "__main__":
    from tests.conftest import make_session
    from quarterdeck.workloads.registry import QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = make_session(), connect(sf)
    for name in names:
        query, sql = QUERIES[name]
        start = time.time()
        try:
            result = compare(spark, con, sf, query, sql) or "ok"
        except Exception as error:
            result = "ERROR " + str(error)[:700]
        print(f"{name:28s} {time.time() - start:6.2f}s {result}", flush=True)
