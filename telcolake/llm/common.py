"""Reading the supplied tables, cutting lineage, running totals."""

from __future__ import annotations

import gc
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telcolake.sources.shared import fresh_path, shared_dir

# Binary columns may hold megabytes a row; Arrow batches are kept short for them.
BATCH_ROWS = 256


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; on a cluster ship it with --py-files."""
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the cluster's shared checkpoint folder.

    Spark's cleaner removes the files when the result is no longer referenced and the
    session asks for it (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, so later reads can prune columns; and its path."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system layer, whatever store holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files and checkpoints that nothing refers to any more.

    Its cleaner acts when the driver collects garbage, which a driver of long loops with
    small results seldom does by itself.
    """
    gc.collect()
    spark._jvm.System.gc()


def running_total(df: DataFrame, keys: list, value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before this one in the order of ``keys``.

    Rows are range-partitioned and sorted once; the sorted rows are checkpointed, because
    range bounds are sampled. Only one sum per partition meets in one task. ``keys`` must
    order rows totally up to rows that are alike; no group is gathered anywhere.
    """
    ordered = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()))
    sums = ordered.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long").alias("_start"))
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_within", T.LongType())])

    def count(parts):
        total = 0
        for batch in parts:
            sizes = batch.column(batch.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype("int64")
            within = total + sizes.cumsum() - sizes
            total += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(within)], names=[*batch.schema.names, "_within"])

    counted = ordered.mapInArrow(count, schema)
    return counted.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_within")).drop("_part", "_start", "_within")


# Keys that hold more than one in so many of all rows; there are at most so many of them.
HOT_KEYS = 20_000


def join_hot(rows: DataFrame, side: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` joined to ``side``, which has one row per ``key`` and in ``size`` how many rows hold it.

    Keys that would fill a task are at most ``HOT_KEYS``: their side is broadcast. All
    others are joined as Spark sees fit. Rows whose key ``side`` lacks are dropped.
    """
    limit = (side.agg(F.sum(size)).first()[0] or 0) / HOT_KEYS
    hot = F.broadcast(side.filter(F.col(size) > limit))
    rest = rows.join(hot.select(key), key, "left_anti").join(side.filter(F.col(size) <= limit), key)
    return rows.join(hot, key).unionByName(rest)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else; pure ASCII text takes the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
