"""One row per key, with a survivor that does not depend on file or task order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of every key in the order of ``order_by`` (default: all columns).

    NULL counts as one key. Spark turns the rank filter into a group limit that runs
    before the shuffle as well, so a key that fills a third of the table reaches the
    shuffle as one row per input task.
    """
    columns = [c for c in (order_by or df.columns) if c != key]
    first = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    return df.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank")


def drop_null_key(df: DataFrame, key: str = "customer_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def distinct_members(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column; NULL is a member."""
    return df.select(column).distinct()
