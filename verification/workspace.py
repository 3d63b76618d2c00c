"""Layers built from one folder of supplied tables, written once per application.

Every query reads the layer it starts from, as the jobs of the library do: cleaning
reads raw rows, dimensions and facts read Silver, features and measures read Gold.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolake.plans import build, model
from telcolake.plans.build import Layout
from telcolake.plans.star import Star
from telcolake.sources import tables
from telcolake.sources.shared import fresh_path, materialize
from telcolake.sources.sizing import fit_tasks
from verification import adapter

SUPPLIED = ("customer", "nation", "region", "orders", "lineitem", "events")


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.layout = Layout(fresh_path(spark, "layers"))

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return adapter.bronze_tables(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return build.build_silver(self.spark, self.layout, self.bronze)

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        _ = self.silver
        return build.build_gold(self.spark, self.layout)

    @cached_property
    def star(self) -> Star:
        return Star(self.gold)

    @cached_property
    def features(self) -> DataFrame:
        _ = self.gold
        return build.build_features(self.spark, self.layout)

    @cached_property
    def matrix(self) -> DataFrame:
        """The model matrix as a table: training passes over it many times."""
        return materialize(model.model_matrix(self.features))

    @cached_property
    def train(self) -> DataFrame:
        return self.matrix.filter(~F.col("is_test")).persist()

    @property
    def test(self) -> DataFrame:
        return self.matrix.filter("is_test")

    @cached_property
    def models(self) -> dict[str, Model]:
        return {}

    def trained(self, learner: str) -> Model:
        if learner not in self.models:
            self.models[learner] = model.LEARNERS[learner](self.train)
        return self.models[learner]

    @cached_property
    def final(self) -> tuple[Model, DataFrame]:
        return model.final_fit_training_auc(self.matrix)

    @cached_property
    def scores(self) -> DataFrame:
        model.churn_scores(self.matrix, self.final[0]).write.mode("overwrite").parquet(self.layout.scores)
        return tables.read_scores(self.spark, self.layout.scores)


_open: dict[tuple, Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of these very files: rewritten tables get new layers."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([f"{sf_dir}/{name}.parquet" for name in SUPPLIED])
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").cast("string").alias("changed"),
        )
        .first()
    )
    key = (spark.sparkContext.applicationId, sf_dir, *files)
    if key not in _open:
        fit_tasks(spark, files["bytes"])
        _open[key] = Workspace(spark, sf_dir)
    return _open[key]
