"""Run registered queries next to their SQL and compare whole results.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import collections
import datetime
import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, run, sql) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    ours, theirs = bag(df.columns, rows), bag(relation.columns, relation.fetchall())
    if ours == theirs:
        return None if rows else "no rows"
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{len(rows)} rows against {theirs.total()}; only ours {only_ours.total()}: "
        f"{[str(r)[:300] for r in list(only_ours)[:2]]}; only theirs {only_theirs.total()}: {[str(r)[:300] for r in list(only_theirs)[:2]]}"
    )


def main(argv):
    from adloom.session import build_session
    from driver_queries import ORACLES, QUERIES

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", 8, {"spark.driver.memory": "10g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        state = "ok  " if problem is None else "FAIL"
        print(f"{state} {name} {time.time() - start:.1f}s {'' if name in ORACLES else '(rows only) '}{problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} ok", "failed: " + " ".join(failed) if failed else "")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
