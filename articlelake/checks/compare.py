"""Compare queries with their SQL answers: ``python -m articlelake.checks.compare [sf_dir] [query ...]``."""

import sys
import time

import duckdb

from articlelake.session import session
from articlelake.checks.duckdb_sql import ORACLES
from articlelake.checks.spark_queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(names), sorted(tuple(repr(row[at]) for at in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str, queries=QUERIES, oracles=ORACLES) -> str | None:
    """None when all rows agree, otherwise what differs."""
    found = queries[name](spark, sf_dir)
    names, rows = _rows(found.columns, found.collect())
    answer = connection.sql(oracles[name])
    want_names, want = _rows(answer.columns, answer.fetchall())
    if names != want_names:
        return f"columns {names} <> {want_names}"
    kinds = dict(zip(answer.columns, map(str, answer.types)))
    kind_names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    for column, kind in found.dtypes:
        if kind_names.get(kind, kind) != kinds[column]:
            return f"type of {column}: {kind} <> {kinds[column]}"
    if rows == want:
        return None
    ours, theirs = set(rows), set(want)
    return (f"rows {len(rows)} <> {len(want)}; only ours {[str(r)[:400] for r in sorted(ours - theirs)[:2]]}; "
            f"only SQL {[str(r)[:400] for r in sorted(theirs - ours)[:2]]}")


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = session(**{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = oracle(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:22s} {time.time() - start:6.2f}s {problem or 'same'}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")


if __name__ == "__main__":
    main(*sys.argv[1:])
