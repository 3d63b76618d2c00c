"""Exact stratified train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolake.operators.keys import surrogate_key


def mark_test_rows(
    df: DataFrame, label: str = "label", row_id: str = "customer_id", fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: true for the first ceil(fraction * n) rows of every label by hash order.

    A label may hold almost all rows, so its rows are never ranked in one task: rows are
    numbered over range partitions in the order of label and hash, and a row's rank is its
    number less those of the labels before it. ``row_id`` must be unique.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.col(row_id), F.lit(str(seed)))))
    numbered = surrogate_key(hashed, [label, "_hash", row_id], "_number", "bigint")
    labels = numbered.groupBy(F.col(label).alias("_label")).agg(F.min("_number").alias("_first"), F.count("*").alias("_total"))
    wanted = F.ceil(F.col("_total") * F.lit(str(fraction)).cast("decimal(10,8)"))
    return (
        numbered.join(labels, F.col(label).eqNullSafe(F.col("_label")))
        .withColumn("is_test", F.col("_number") - F.col("_first") + 1 <= wanted)
        .select(*df.columns, "is_test")
    )


def stratified_split(
    df: DataFrame, label: str = "label", row_id: str = "customer_id", fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test)"""
    marked = mark_test_rows(df, label, row_id, fraction, seed)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")
