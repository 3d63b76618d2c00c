"""Intermediate tables in the shared folder of the cluster.

A table written here cuts lineage: later stages read fixed rows, so a lost executor
never makes Spark redo (and possibly re-sample) what lies before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder.

    Spark's cleaner removes the files when the result is no longer referenced and
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
