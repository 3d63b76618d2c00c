"""Churn model: preparation, three learners, evaluation and the score table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telcolake.operators.encode import category_dictionaries, median_impute, medians, one_hot_vectors
from telcolake.operators.forest import fit_forest
from telcolake.operators.keys import surrogate_key
from telcolake.operators.split import mark_test_rows
from telcolake.sources.schemas import SCORES_DDL, ddl_columns
from telcolake.sources.together import together

# Model inputs in their order, and the features of the leak check.
CATEGORICAL = ("customer_type", "plan_type", "contract_type", "region")
NUMERIC = (
    "monthly_charge_aud",
    "tenure_months",
    "has_cybersecurity_addon_num",
    "has_voip_addon_num",
    "avg_daily_bandwidth_gb",
    "avg_peak_latency_ms",
    "avg_offpeak_latency_ms",
    "avg_packet_loss_pct",
    "avg_connection_drops",
    "outage_days",
    "sla_breach_days",
    "ticket_count",
    "ticket_resolved_rate",
    "avg_ticket_satisfaction",
    "avg_resolution_days",
    "billing_cycles",
    "avg_amount_charged",
    "late_rate",
    "failed_rate",
)
LEAK_CHECK = (
    "tenure_months",
    "ticket_count",
    "ticket_resolved_rate",
    "avg_ticket_satisfaction",
    "late_rate",
    "failed_rate",
    "sla_breach_days",
)
# The fields of the risk page, around the score.
RISK_ATTRIBUTES = ("customer_id", "region", "plan_type", "contract_type", "tenure_months")
RISK_DRIVERS = ("sla_breach_days", "failed_rate", "ticket_count")
# The seed of every random choice, and the learners' settings below.
SEED = 42


def label_rows(features: DataFrame) -> DataFrame:
    """Rows with a known churn flag, and the flag as 0/1 label."""
    return features.filter(F.col("churn_flag").isNotNull()).withColumn("label", F.col("churn_flag").cast("int"))


def bool_to_num(df: DataFrame) -> DataFrame:
    flags = ("has_cybersecurity_addon", "has_voip_addon")
    return df.withColumns({f"{c}_num": F.col(c).cast("int") for c in flags})


def select_model_columns(df: DataFrame) -> DataFrame:
    return df.select(*CATEGORICAL, *NUMERIC, "label", "customer_id")


def model_columns(features: DataFrame) -> DataFrame:
    return select_model_columns(bool_to_num(label_rows(features)))


def model_matrix(features: DataFrame, fit_on_train: bool = False) -> DataFrame:
    """Model columns plus ``is_test`` and the assembled vector ``features``.

    Raw columns stay beside the vector, so scores can carry the un-imputed values.
    Medians are taken over all rows, or over the training part with ``fit_on_train``.
    """
    rows = model_columns(features)
    marked = mark_test_rows(rows, seed=SEED)
    dictionaries = category_dictionaries(rows, CATEGORICAL)
    fitted = medians(marked.filter(~F.col("is_test")) if fit_on_train else rows, NUMERIC)
    encoded = median_impute(one_hot_vectors(marked, dictionaries), NUMERIC, fitted, suffix="_filled")
    # A column without any value has no median and carries no signal.
    numbers = [f"{c}_filled" for c in NUMERIC if fitted[c] is not None]
    inputs = numbers + [f"{c}_vector" for c in CATEGORICAL if f"{c}_vector" in encoded.columns]
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(encoded)
    return assembled.select("customer_id", *CATEGORICAL, *NUMERIC, "label", "is_test", "features")


def train_logistic(train: DataFrame, c: float = 1.0, max_iter: int = 2000) -> Model:
    """L2-regularised logistic regression on unscaled features.

    The objective is 1/2 |w|^2 + c * sum(loss); Spark averages the loss over the rows,
    hence regParam = 1 / (c * n). The tolerance is tight enough for ``optimality``.
    """
    rows = train.count()
    return LogisticRegression(
        maxIter=max_iter, tol=1e-9, regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False
    ).fit(train)


def train_gbt(train: DataFrame, trees: int = 200) -> Model:
    return GBTClassifier(maxIter=trees, stepSize=0.1, maxDepth=3, seed=SEED).fit(train)


def train_random_forest(train: DataFrame, trees: int = 200) -> Model:
    # 30 is the greatest depth Spark grows. Its own learner holds all nodes in the driver.
    return fit_forest(train, trees, depth=30, seed=SEED)


# Model names of the comparison.
LEARNERS = {
    "Logistic Regression": train_logistic,
    "Gradient Boosting": train_gbt,
    "Random Forest": train_random_forest,
}


def predict_probability(model: Model, df: DataFrame) -> DataFrame:
    """Add ``churn_probability``."""
    scored = model.transform(df)
    probability = vector_to_array("probability")[1].alias("churn_probability")
    return scored.select(*df.columns, probability)


def roc_aucs(scored: DataFrame, by: str = "model", score: str = "churn_probability", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve per value of ``by``; tied scores count one half.

    The area is the share of (churner, stayer) pairs in the right order. Equal scores fold to
    one row, which is range-partitioned; each partition adds up its own pairs and its class
    sizes, and only these, one row per partition, are put in order for the pairs across
    partitions. Nothing runs before the result is asked for. NULL where a class is missing.
    """
    value, positive = F.col(score).cast("double"), F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    tied = scored.groupBy(by, value.alias("_score")).agg(positive.alias("_pos"), (F.count("*") - positive).alias("_neg"))
    parted = tied.repartitionByRange(by, "_score").withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy(by, "_part").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0)).cast("double")
    pairs = parted.select(by, "_part", "_pos", "_neg", (F.col("_pos") * (below + F.col("_neg") / 2)).alias("_pairs"))
    sums = pairs.groupBy(by, "_part").agg(*[F.sum(c).cast("double").alias(c) for c in ("_pos", "_neg", "_pairs")])
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    across = F.col("_pos") * F.coalesce(F.sum("_neg").over(before), F.lit(0.0))
    whole = sums.withColumn("_pairs", F.col("_pairs") + across).groupBy(by).agg(*[F.sum(c).alias(c) for c in ("_pos", "_neg", "_pairs")])
    return whole.select(by, F.try_divide(F.col("_pairs"), F.col("_pos") * F.col("_neg")).alias("auc"))


def roc_auc(df: DataFrame, score: str = "churn_probability", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve in one row."""
    return roc_aucs(df.select(F.lit("").alias("model"), score, label), "model", score, label).select("auc")


def model_comparison(scored: Mapping[str, DataFrame]) -> DataFrame:
    """One row per model (name -> rows with label and probability): its name and its AUC, all in one pass."""
    rows = [df.select(F.lit(name).alias("model"), "label", "churn_probability") for name, df in scored.items()]
    return roc_aucs(reduce(DataFrame.unionByName, rows))


def optimality(model: Model, rows: DataFrame, c: float = 1.0) -> DataFrame:
    """Certificate of a fitted logistic regression: (input, gradient, scale) of its objective at the weights.

    The objective 1/2 |w|^2 + c * sum(loss) is convex and its minimum the only place with
    gradient 0, so the weights are proved right without another learner. Input -1 is the
    intercept. ``scale`` is the sum of the terms' sizes, which the gradient is small against.
    One aggregate over the rows; whatever their number, it returns one row per input.
    """
    x = vector_to_array("features")
    scored = model.transform(rows).select((vector_to_array("probability")[1] - F.col("label")).alias("_off"), x.alias("_x"))
    cells = scored.select("_off", F.posexplode(F.concat(F.array(F.lit(1.0)), "_x")).alias("_at", "_value"))
    terms = F.col("_off") * F.col("_value")
    sums = cells.groupBy((F.col("_at") - 1).alias("input")).agg(F.sum(terms).alias("_sum"), F.sum(F.abs(terms)).alias("_size"))
    weights = rows.sparkSession.createDataFrame([(-1, 0.0), *enumerate(model.coefficients.toArray().tolist())], "input int, weight double")
    total = F.col("weight") + c * F.col("_sum")
    return sums.join(weights, "input").select("input", total.alias("gradient"), (F.abs("weight") + c * F.col("_size")).alias("scale"))


def permutation_importance(model: Model, rows: DataFrame, row_id: str = "customer_id", seed: int = SEED) -> DataFrame:
    """(input, auc, importance): what the AUC loses when one input is shuffled among the rows.

    Rows stand in a random order over range partitions; input j of a row is taken from the
    row that stands j + 1 places further. Each row is scored once per input in one job, and the
    areas of all copies are computed in one pass. Input -1 is the area of the rows as they are.
    """
    hashed = rows.select(row_id, "label", vector_to_array("features").alias("_x"), F.md5(F.concat(F.col(row_id), F.lit(str(seed)))).alias("_hash"))
    numbered = surrogate_key(hashed, ["_hash", row_id], "_at", "bigint")
    n = numbered.count()
    size = model.numFeatures
    copies = numbered.select("label", "_x", "_at", F.explode(F.sequence(F.lit(-1), F.lit(size - 1))).alias("input"))
    partner = F.pmod(F.col("_at") + F.col("input"), F.lit(max(n, 1))) + 1  # keys count from 1: input -1 is the row itself
    given = numbered.select(F.col("_at").alias("_from"), F.col("_x").alias("_y"))
    paired = copies.withColumn("_from", F.when(F.col("input") < 0, F.col("_at")).otherwise(partner)).join(given, "_from")
    mixed = F.transform("_x", lambda v, i: F.when(i == F.col("input"), F.get("_y", i)).otherwise(v))
    scored = predict_probability(model, paired.select("input", "label", array_to_vector(mixed).alias("features")))
    areas = roc_aucs(scored, by="input")
    whole = F.max(F.when(F.col("input") == -1, F.col("auc"))).over(Window.partitionBy())  # one row per input
    return areas.select("input", "auc", (whole - F.col("auc")).alias("importance"))


def leak_check(labelled: DataFrame) -> DataFrame:
    """Means of the strongest features by label."""
    return labelled.groupBy("label").agg(*[F.avg(c).alias(c) for c in LEAK_CHECK])


def compare_models(matrix: DataFrame) -> DataFrame:
    """Train every learner on the training part and compare them on the test part.

    The learners are independent and boosting is a long chain of short jobs, so they
    train side by side on one cached training part.
    """
    train, test = matrix.filter(~F.col("is_test")).persist(), matrix.filter("is_test")

    try:
        models = together({name: partial(fit, train) for name, fit in LEARNERS.items()})
    finally:
        train.unpersist()
    return model_comparison({name: predict_probability(model, test) for name, model in models.items()})


def final_fit_training_auc(matrix: DataFrame) -> tuple[Model, DataFrame]:
    """The published model: logistic regression on all rows, with its in-sample AUC."""
    model = train_logistic(matrix)
    auc = roc_auc(predict_probability(model, matrix)).withColumnRenamed("auc", "training_auc")
    return model, auc


def churn_scores(matrix: DataFrame, model: Model) -> DataFrame:
    """One row per labelled customer: filter columns, features, flag and probability."""
    scored = predict_probability(model, matrix).withColumnRenamed("label", "churn_flag")
    return scored.select(*[F.col(name).cast(kind).alias(name) for name, kind in ddl_columns(SCORES_DDL)])


def scores_preview(scores: DataFrame, n: int = 5) -> DataFrame:
    return scores.orderBy("customer_id").limit(n)


def at_risk_customers(
    scores: DataFrame, k: int = 20, score: str = "churn_probability", filters: Mapping[str, list] | None = None
) -> DataFrame:
    """The ``k`` customers most likely to churn, under segment filters ``{column: values}``."""
    for column, values in (filters or {}).items():
        scores = scores.filter(F.col(column).isin(*values))
    return scores.select(*RISK_ATTRIBUTES, score, *RISK_DRIVERS).orderBy(F.desc_nulls_last(score), "customer_id").limit(k)


def risk_by_segments(scores: DataFrame, segments: Sequence[str], score: str = "churn_probability") -> DataFrame:
    """``risk_by_segment`` for several columns in one pass: segment, member, mean and number of customers."""
    whole = scores.groupingSets([[F.col(s)] for s in segments], *segments).agg(
        F.avg(score).alias("avg_probability"), F.count("*").alias("customers"), *[F.grouping(s).alias(f"_no_{s}") for s in segments]
    )
    segment = F.concat_ws("", *[F.when(F.col(f"_no_{s}") == 0, s) for s in segments])
    return whole.select(segment.alias("segment"), F.coalesce(*[F.col(s).cast("string") for s in segments]).alias("member"), "avg_probability", "customers")


def risk_by_segment(scores: DataFrame, segment: str, score: str = "churn_probability") -> DataFrame:
    return scores.groupBy(segment).agg(F.avg(score).alias("avg_probability"), F.count("*").alias("customers"))
