"""Learners on the test data: probabilities, comparison, the published scores."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from telcolake.plans import build, model
from telcolake.sources import tables
from telcolake.sources.schemas import SCORES_DDL
from telcolake.sources.shared import fresh_path
from verification.workspace import workspace

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return workspace(spark, SF_DIR)


def test_small_ensembles(w):
    for fit in (model.train_gbt, model.train_random_forest):
        scored = model.predict_probability(fit(w.train, trees=3), w.test)
        low, high = scored.agg(F.min("churn_probability"), F.max("churn_probability")).first()
        assert 0 <= low <= high <= 1
        assert 0 <= model.roc_auc(scored).first().auc <= 1


def test_scores(w):
    scores = w.scores
    assert ", ".join(f"{c} {t}" for c, t in scores.dtypes) == SCORES_DDL
    assert scores.count() == w.features.filter("churn_flag is not null").count()
    assert scores.filter("churn_probability is null or churn_probability not between 0 and 1").count() == 0
    # Un-imputed: customers without tickets keep NULL.
    assert scores.filter("ticket_count is null").count() > 0


def test_logistic_is_at_the_optimum(w):
    """A tighter fit does not change the loss: the penalty 1/(C n) is applied as meant."""
    fitted = model.train_logistic(w.train)
    n = w.train.count()
    tight = LogisticRegression(maxIter=5000, tol=1e-12, regParam=1.0 / n, standardization=False).fit(w.train)
    assert fitted.summary.objectiveHistory[-1] == pytest.approx(tight.summary.objectiveHistory[-1], rel=1e-5)


def test_fit_on_train_uses_other_medians(w):
    matrix = model.model_matrix(w.features, fit_on_train=True)
    assert matrix.count() == w.matrix.count()


def test_build_scores(spark, w, monkeypatch):
    monkeypatch.setattr(
        model, "LEARNERS", {"Logistic Regression": model.train_logistic, "Random Forest": lambda t: model.train_random_forest(t, 3)}
    )
    layout = build.Layout(fresh_path(spark, "test"))
    tables.write_features(w.features, layout.features)
    scores, comparison = build.build_scores(spark, layout, "test_ml", f"{layout.root}/warehouse")
    assert scores.count() == w.scores.count()
    areas = {r.model: r.auc for r in comparison.collect()}
    assert set(areas) == {"Logistic Regression", "Random Forest", build.TRAINING} and 0.5 < areas[build.TRAINING] <= 1
    inventory = tables.table_inventory(spark, ["test_ml"]).collect()
    assert [(r.table_name, r.table_type) for r in inventory] == [("churn_scores", "EXTERNAL")]
    columns = tables.column_inventory(spark, ["test_ml"]).orderBy("ordinal_position").collect()
    assert ", ".join(f"{r.column_name} {r.data_type.lower()}" for r in columns) == SCORES_DDL


# --- areas, certificates, importances ------------------------------------------------------


def plain_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("levels", [1, 4, 10_000])
def test_auc_counts_ties_one_half(spark, levels):
    import random

    draw = random.Random(levels)
    rows = [(m, draw.randrange(levels) / levels, int(draw.random() < 0.3)) for m in ("a", "b") for _ in range(400)]
    df = spark.createDataFrame([*rows, ("one class", 0.5, 1)], "model string, churn_probability double, label int")
    got = {r.model: r.auc for r in model.roc_aucs(df).collect()}
    for m in ("a", "b"):
        assert got[m] == pytest.approx(plain_auc([(s, y) for x, s, y in rows if x == m]), abs=1e-12)
    assert got["one class"] is None
    assert model.roc_aucs(df.limit(0)).count() == 0


def test_auc_equals_the_learners_figure(w):
    fitted = model.train_logistic(w.train)
    scored = model.predict_probability(fitted, w.train)
    assert model.roc_auc(scored).first().auc == pytest.approx(fitted.summary.areaUnderROC, abs=1e-9)


def test_planning_an_area_runs_no_job(spark, w):
    scored = model.predict_probability(model.train_logistic(w.train), w.test)
    spark.sparkContext.setJobGroup("areas", "areas")
    compared = model.model_comparison({"x": scored, "y": scored})
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("areas")) == []
    assert compared.count() == 2
    text = compared._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" in text and "SinglePartition" not in text


def test_optimality_tells_right_from_wrong_weights(w):
    right, wrong = model.train_logistic(w.train), model.train_logistic(w.train, c=0.01)
    of = lambda m: {r.input: abs(r.gradient) / r.scale for r in model.optimality(m, w.train).collect()}
    assert max(of(right).values()) < 1e-4
    assert max(of(wrong).values()) > 1e-2
    assert min(of(right)) == -1 and len(of(right)) == right.numFeatures + 1


def test_gradient_equals_differences_of_the_objective(w):
    """The certificate's gradient against the change of the objective itself."""
    import numpy as np

    fitted = model.train_logistic(w.train, c=0.01)
    rows = w.train.select("features", "label").collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])
    beta, b = fitted.coefficients.toArray(), fitted.intercept

    def objective(v, k):
        z = x @ v + k
        return v @ v / 2 + np.sum(np.logaddexp(0, z) - y * z)

    got = {r.input: (r.gradient, r.scale) for r in model.optimality(fitted, w.train).collect()}
    for j in (-1, 0, 3, len(beta) - 1):
        step = np.zeros(len(beta) + 1)
        # Small beside the input's values: inputs are not scaled.
        step[j + 1] = h = 1e-4 / (1 + (np.abs(x[:, j]).max() if j >= 0 else 0))
        diff = (objective(beta + step[1:], b + step[0]) - objective(beta - step[1:], b - step[0])) / (2 * h)
        assert got[j][0] == pytest.approx(diff, abs=1e-4 * got[j][1])


def test_permutation_importance_finds_the_input_that_counts(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(f"c{i:04d}", int(i % 3 == 0), Vectors.dense([float(i % 3 == 0), float(i % 7), 1.0])) for i in range(600)]
    df = spark.createDataFrame(rows, ["customer_id", "label", "features"])
    fitted = LogisticRegression(regParam=0.01).fit(df)
    got = {r.input: r for r in model.permutation_importance(fitted, df).collect()}
    assert set(got) == {-1, 0, 1, 2} and got[-1].auc == 1 and got[-1].importance == 0
    assert got[0].importance > 0.3 and abs(got[1].importance) < 0.05 and abs(got[2].importance) < 1e-9
