"""Compare every query with its SQL: ``python -m verification.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from verification.queries import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        path = f"{sf_dir}/{name}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        if os.path.exists(path) or path.endswith("*.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def normalised(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted; exact values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


# Spark type -> SQL type of the other engine.
SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = normalised(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    types = {d[0]: str(d[1]) for d in result.description}
    for name, kind in spark_df.dtypes:
        if SQL_TYPES.get(kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    actual = normalised(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, con, ORACLE[name]) if name in ORACLE else None
            rows = "" if name in ORACLE else f" rows={df.count()}"
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{rows} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
