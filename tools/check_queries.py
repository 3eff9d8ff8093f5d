"""Run queries next to their SQL and compare columns, types and rows.

    python tools/check_queries.py [--data DIR] [--time] [NAME ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from tideload.queries import ORACLES, QUERIES
from tideload.queries.registry import TABLES, clear_query_data
from tideload.session import build_session

_TYPES = {
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, folder: str) -> list[str]:
    """Differences between a query and its SQL, empty if none."""
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    found = []
    if sorted(df.columns) != sorted(columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    duck = {d[0]: str(d[1]) for d in cursor.description}
    for column, spark_type in df.dtypes:
        expected = _TYPES.get(spark_type, spark_type)
        actual = duck.get(column, "")
        if not expected.startswith("decimal") and actual != expected:
            found.append(f"type of {column}: {spark_type} and {actual}")
        if expected.startswith("decimal") and expected.split(",")[-1].strip(")") != actual.split(",")[-1].strip(")"):
            found.append(f"scale of {column}: {spark_type} and {actual}")
    if got != want:
        found.append(f"rows {sum(got.values())} and {sum(want.values())}")
        found += [f"  only Spark: {r}" for r in list((got - want).elements())[:3]]
        found += [f"  only SQL:   {r}" for r in list((want - got).elements())[:3]]
    if not got:
        found.append("no rows")
    return found


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--data", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.data)
    bad = 0
    for name in args.names or sorted(QUERIES):
        begun = time.time()
        try:
            found = compare(spark, con, name, args.data)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        clear_query_data(spark)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - begun:.1f}s", flush=True)
        for line in found:
            print("     ", line)
        bad += bool(found)
    print(f"{bad} of {len(args.names or QUERIES)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
