"""Compare registered queries with their SQL twins: ``python -m tidemark.plans.check DIR [names]``."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, bool):
        return value
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=sort_key)


def oracle_connection(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder: str, name: str) -> tuple[str, int]:
    from tidemark.plans.catalog import ORACLES, QUERIES

    df = QUERIES[name](spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return ("rows-only", len(mine))
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return (f"COLUMNS {sorted(df.columns)} != {sorted(names)}", len(mine))
    if len(mine) != len(theirs):
        return (f"ROWS {len(mine)} != {len(theirs)}", len(mine))
    for a, b in zip(mine, theirs):
        if a != b:
            return (f"VALUES {a} != {b}", len(mine))
    return ("ok", len(mine))


def main(argv: list[str]) -> int:
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import local_session

    folder = argv[0]
    names = [n for n in QUERIES if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    spark, con = local_session(8), oracle_connection(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            verdict, count = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            verdict, count = f"ERROR {type(error).__name__} {str(error)[:600]}", -1
        bad += verdict not in ("ok", "rows-only")
        print(f"{name:28s} {count:8d} {time.time() - start:6.2f}s {verdict[:900]}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
