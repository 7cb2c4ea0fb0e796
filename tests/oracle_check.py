"""Side-by-side check of registered queries against their DuckDB SQL.

Mirrors the driver's gate: row count, column names/types and an
order-insensitive hash of the values (columns sorted by name).

    python tests/oracle_check.py [sf_dir] [name ...]
    ORACLE_TZ=America/New_York python tests/oracle_check.py ...   # non-UTC session
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import __spark_entry__ as entry  # noqa: E402
from cartwheel.session import build_session  # noqa: E402
from cartwheel.sources.driver_tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import os
    conf = {"spark.sql.session.timeZone": os.environ["ORACLE_TZ"]} if os.environ.get("ORACLE_TZ") else {}
    spark = build_session("local[8]", conf=conf)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    ok = True
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            print(f"{name:32s} rows={len(rows):7d} (no oracle) spark={t1 - t0:.1f}s")
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        scols = df.columns
        same_cols = sorted(scols) == sorted(dcols)
        hs, hd = digest(scols, rows), digest(dcols, drows)
        good = same_cols and len(rows) == len(drows) and hs == hd
        ok &= good
        print(f"{name:32s} {'OK ' if good else 'BAD'} rows={len(rows)}/{len(drows)} "
              f"cols={'=' if same_cols else (scols, dcols)} hash={hs}/{hd} spark={t1 - t0:.1f}s")
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
