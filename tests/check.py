"""Compare registered queries with their SQL: python tests/check.py [sf] [name …]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402
from gridpulse.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents " \
    "embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, name, sf_dir, allow_empty=False):
    """Problems found, empty when both engines give the same rows."""
    frame = spark_entry.queries()[name](spark, sf_dir)
    actual = normal([tuple(r) for r in frame.collect()], frame.columns)
    cursor = con.execute(spark_entry.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    expected = normal(cursor.fetchall(), columns)
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {frame.columns} against {columns}"]
    if actual != expected:
        extra = sorted(set(actual) - set(expected))[:3]
        lost = sorted(set(expected) - set(actual))[:3]
        sizes = f"{len(actual)} rows against {len(expected)}"
        return [sizes, f"extra {extra}", f"lost {lost}"]
    return [] if actual or allow_empty else ["no rows"]


def main(scale="0.01", *names):
    sf_dir = f"/root/testdata/sf{scale}"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names or spark_entry.queries():
        began = time.time()
        try:
            problems = compare(spark, con, name, sf_dir)
        except Exception as error:  # a failing query must not hide the others
            problems = [repr(error)[:600]]
        print(f"{time.time() - began:6.2f}s {name}: {problems or 'ok'}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
