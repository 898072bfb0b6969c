"""Compare every registered query with its SQL on the parquet tables of a folder.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "item"):
        return plain(value.item())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if type(value).__name__ == "Decimal":
        return float(value)
    return value


def rows_of(columns, rows):
    """Rows with columns in name order, as a sorted list of plain tuples."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in places) for row in rows), key=repr)


def oracle_connection(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}; first {got[:2]} against {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    import __spark_entry__ as contract

    from inkwell.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = []
    for name, build in queries.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        began = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                why = difference(df, con, oracles[name])
            else:
                why = None if df.count() >= 0 else "no rows"
        except Exception:
            why = traceback.format_exc(limit=-3)[-1500:]
        took = time.time() - began
        print(f"{'FAIL' if why else 'ok  '} {took:6.2f}s {'sql ' if name in oracles else 'rows'} {name} {why or ''}", flush=True)
        if why:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
