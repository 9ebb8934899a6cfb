"""Compares a query with its SQL counterpart, as a multiset of rows.

    python -m tests.compare [scale folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _as_bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark type -> the type the other engine should report.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark: SparkSession, sf_dir: str, query, sql: str) -> list[str]:
    """What differs, in words; empty if names, types and rows all agree."""
    frame = query(spark, sf_dir)
    connection = oracle_connection(sf_dir)
    cursor = connection.execute(sql)
    names = [part[0] for part in cursor.description]
    types = {part[0]: str(part[1]) for part in cursor.description}
    expected = _as_bag(names, cursor.fetchall())
    found = _as_bag(frame.columns, [tuple(row) for row in frame.collect()])
    problems = []
    if sorted(frame.columns) != sorted(names):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(names)}")
    else:
        for name, kind in frame.dtypes:
            if SAME_TYPE.get(kind) != types[name]:
                problems.append(f"type of {name}: {kind} / {types[name]}")
    missing, extra = expected - found, found - expected
    if missing or extra:
        problems.append(
            f"{sum(missing.values())} rows missing, {sum(extra.values())} extra, "
            f"of {sum(expected.values())}: {list(missing)[:2]} / {list(extra)[:2]}"
        )
    return problems


def main(sf_dir: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from kerbline import build_session

    spark = build_session("compare", "local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    texts, bad = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        if name not in texts:
            print(f"{name}: no counterpart, {query(spark, sf_dir).count()} rows")
            continue
        try:
            problems = differences(spark, sf_dir, query, texts[name])
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{name}: {'; '.join(problems) or 'agrees'}  ({time.time() - start:.1f} s)")
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(*arguments))
