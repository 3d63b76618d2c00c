"""The batch jobs between layers: each reads written tables and writes the next layer."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolake.plans import gold as star_schema
from telcolake.plans.calendar import CALENDAR_END, CALENDAR_START
from telcolake.plans.features import churn_features
from telcolake.plans.model import churn_scores, compare_models, final_fit_training_auc, model_matrix
from telcolake.plans.silver import silver_tables
from telcolake.sources import tables, versions
from telcolake.sources.shared import materialize
from telcolake.sources.sizing import bytes_of, fit_tasks
from telcolake.sources.together import together


# Name of the published model's in-sample AUC among the compared ones.
TRAINING = "Logistic Regression, all rows, in-sample"


@dataclass(frozen=True)
class Layout:
    """Where the layers live under one root."""

    root: str
    gold_root: str | None = None  # below ``root`` unless given

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return self.gold_root or f"{self.root}/gold"

    @property
    def keys(self) -> str:
        return f"{self.gold}-keys"

    @property
    def features(self) -> str:
        return f"{self.root}/ml/churn_feature_table"

    @property
    def scores(self) -> str:
        return f"{self.root}/ml/churn_scores"


def build_bronze(spark: SparkSession, layout: Layout, landing: Mapping[str, str]) -> dict[str, DataFrame]:
    """Copy the CSV file sets (name -> path) to raw tables, side by side; bad rows are set aside."""

    def copy(name: str, path: str):
        return lambda: tables.ingest_csv_to_bronze(spark, path, name, f"{layout.bronze}/{name}")

    together({name: copy(name, path) for name, path in landing.items()})
    return tables.read_bronze(spark, layout.bronze)


def build_all(spark: SparkSession, layout: Layout, landing: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """From CSV files to (scores, model comparison)."""
    build_bronze(spark, layout, landing)
    build_silver(spark, layout)
    build_gold(spark, layout, schema=tables.GOLD_SCHEMA)
    build_features(spark, layout)
    return build_scores(spark, layout)


def build_silver(
    spark: SparkSession, layout: Layout, bronze: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Clean the raw tables of the layout, or the given frames."""
    if bronze is None:
        fit_tasks(spark, bytes_of(spark, [layout.bronze]))
        bronze = tables.read_bronze(spark, layout.bronze)
    tables.write_silver(silver_tables(bronze), layout.silver)
    return tables.read_silver(spark, layout.silver)


def build_gold(
    spark: SparkSession,
    layout: Layout,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    fmt: str = "parquet",
    schema: str | None = None,
    location: str | None = None,
) -> dict[str, DataFrame]:
    """A new version of the Gold tables; with ``schema`` the catalog's tables are moved to it.

    Keys first: members of earlier loads keep theirs, new ones are added to the key maps.
    Then dimensions; facts look their keys up in the written dimensions. Read back from
    files, a dimension has a known size, and its keys are assigned once instead of once per
    fact. Readers see the version before until all tables are written.
    """
    fit_tasks(spark, bytes_of(spark, [layout.silver]))
    silver = tables.read_silver(spark, layout.silver)
    maps = _extend_key_maps(spark, layout, silver)
    version = versions.new_version(layout.gold)
    dims = star_schema.keyed_dimensions(spark, silver, maps, start, end)
    tables.write_gold_paths(dims, version, fmt)
    dims = tables.read_gold(spark, version, dims, fmt)
    tables.write_gold_paths(star_schema.facts(silver, dims, start, end), version, fmt)
    versions.publish(spark, version)
    if schema is not None:
        tables.publish_gold(spark, layout.gold, schema, fmt, location)
    return tables.read_gold(spark, layout.gold, fmt=fmt)


def _extend_key_maps(spark: SparkSession, layout: Layout, silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The key maps with the members of this load, as a new version.

    It is published before the dimensions are written: a job that fails later leaves keys
    that nothing uses yet, and the next one gives its members the same.
    """
    earlier = versions.published(spark, layout.keys)
    version = versions.new_version(layout.keys)

    def read(at: str, name: str) -> DataFrame:
        _, member, key = star_schema.MEMBERS[name]
        return spark.read.schema(f"{key} int, {member} string").parquet(f"{at}/{name}")

    def extend(name: str):
        def job():
            known = read(earlier[-1], name) if earlier else None
            star_schema.key_map(silver, name, known).write.parquet(f"{version}/{name}")

        return job

    together({name: extend(name) for name in star_schema.MEMBERS})
    versions.publish(spark, version)
    return {name: read(version, name) for name in star_schema.MEMBERS}


def build_features(spark: SparkSession, layout: Layout) -> DataFrame:
    fit_tasks(spark, bytes_of(spark, [versions.current(spark, layout.gold)]))
    tables.write_features(churn_features(tables.read_gold(spark, layout.gold)), layout.features)
    return tables.read_features(spark, layout.features)


def build_scores(
    spark: SparkSession, layout: Layout, schema: str = tables.ML_SCHEMA, location: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(scores, AUC per model): three learners compared, the published one refitted and its in-sample AUC."""
    # Training passes over the matrix many times; as a table it also survives lost executors.
    matrix = materialize(model_matrix(tables.read_features(spark, layout.features))).persist()
    try:
        done = together({"comparison": lambda: compare_models(matrix), "final": lambda: final_fit_training_auc(matrix)})
        final, training = done["final"]
        of_training = training.select(F.lit(TRAINING).alias("model"), F.col("training_auc").alias("auc"))
        # Areas are computed when asked for: once, while the matrix is at hand.
        comparison = materialize(done["comparison"].unionByName(of_training))
        tables.write_scores(churn_scores(matrix, final), layout.scores, schema, location=location)
    finally:
        matrix.unpersist()
    return tables.read_scores(spark, layout.scores), comparison
