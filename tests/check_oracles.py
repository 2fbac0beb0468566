"""Compare every registered query with its SQL in DuckDB: `python -m tests.check_oracles [sf dir] [name ...]`.

With SHUFFLE=1 nothing is broadcast by size, as with tables of cluster size.
"""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def _lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(db, frame, sql):
    """Empty when columns and rows agree, whatever the row order."""
    relation = db.sql(sql)
    wanted = sorted(relation.columns)
    if sorted(frame.columns) != wanted:
        return f"columns {sorted(frame.columns)} instead of {wanted}"
    ours = _lines(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = _lines(relation.columns, relation.fetchall())
    if ours == theirs:
        return ""
    only = [x for x in set(ours) - set(theirs)][:2], [x for x in set(theirs) - set(ours)][:2]
    return f"{len(ours)} rows instead of {len(theirs)}; only here {only[0]}, only there {only[1]}"


def main(folder="/root/testdata/sf0.01", *names):
    from __spark_entry__ import oracle_sql, queries
    from tablekeeper.session import build_session

    spark = build_session("local[8]", **{"spark__sql__shuffle__partitions": "8", "spark__ui__enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("SHUFFLE"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    db, sql, failed = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            problem = differences(db, frame, sql[name]) if name in sql else ""
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{failed} of {len(names) or len(sql)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
