"""Run catalog queries and their SQL side by side: python tests/compare.py [folder] [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else repr(value))
    if isinstance(value, int):
        return (3, str(value))
    return (4, str(value))


def canonical(table):
    names = sorted(table.column_names)
    rows = sorted(
        tuple(cell(v) for v in row) for row in zip(*(table[n].to_pylist() for n in names))
    )
    return names, rows


def kind(field) -> str:
    import pyarrow.types as t

    for name, test in (
        ("bool", t.is_boolean), ("int", t.is_integer), ("float", t.is_floating),
        ("text", lambda x: t.is_string(x) or t.is_large_string(x)),
    ):
        if test(field.type):
            return name
    return str(field.type)


def difference(spark_table, sql_table) -> str | None:
    """None when equal in names, kinds and values; otherwise the first thing that differs."""
    for field in spark_table.schema:
        if field.name in sql_table.column_names:
            other = sql_table.schema.field(field.name)
            if kind(field) != kind(other):
                return f"{field.name}: {field.type} / {other.type}"
    names, rows = canonical(spark_table)
    other_names, other_rows = canonical(sql_table)
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(rows) != len(other_rows):
        return f"rows {len(rows)} / {len(other_rows)}"
    for mine, theirs in zip(rows, other_rows):
        if mine != theirs:
            return f"{mine} / {theirs}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    sql = oracle_sql()
    for name, run in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            mine = run(spark, folder).toArrow()
            took = time.time() - start
            if name not in sql:
                print(f"ROWS {name} {mine.num_rows} {took:.2f}s", flush=True)
                continue
            start = time.time()
            theirs = con.sql(sql[name]).to_arrow_table()
            problem = difference(mine, theirs)
            verdict = f"DIFF {problem[:600]}" if problem else "OK"
            print(
                f"{'DIFF' if problem else 'OK'} {name} {mine.num_rows} {took:.2f}s "
                f"sql {time.time() - start:.2f}s {'' if not problem else verdict}",
                flush=True,
            )
        except Exception as error:  # noqa: BLE001
            print(f"FAIL {name} {str(error)[:600]}", flush=True)


if __name__ == "__main__":
    main()
