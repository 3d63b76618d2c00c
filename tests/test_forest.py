"""The forest that grows tree by tree in tasks: its trees, its thresholds, and how it is held."""

import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.wrapper import JavaModel
from pyspark.sql import functions as F

from telcolake.operators import forest
from telcolake.plans import model


def made_rows(n, seed=1):
    """A label that follows two of four inputs, with noise."""
    draw = random.Random(seed)
    for i in range(n):
        a, b, c, d = draw.random(), draw.randrange(5), draw.gauss(0, 1), float(i % 2)
        yield f"c{i}", int((a > 0.6) ^ (b == 3) if draw.random() < 0.9 else draw.random() < 0.5), Vectors.dense([a, b, c, d])


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(list(made_rows(1500)), ["customer_id", "label", "features"])


def blocks_of(seed=3, sizes=(400, 1, 0, 300), width=6):
    draw = np.random.default_rng(seed)
    blocks = []
    for n in sizes:
        x = draw.integers(0, forest.BINS, (n, width), dtype=np.uint8)
        blocks.append(SimpleNamespace(value=(x, ((x[:, 0] > 12) ^ (draw.random(n) < 0.3)).astype(np.uint8))))
    return blocks


def same(a, b):
    return a.keys() == b.keys() and all(np.array_equal(a[k], b[k]) for k in a)


def test_no_node_is_an_object_of_the_driver(rows):
    fitted = model.train_random_forest(rows, trees=5)
    assert not isinstance(fitted, JavaModel) and not hasattr(fitted, "_java_obj")
    assert fitted.getNumTrees == 5 and fitted.totalNumNodes > 5 * 50
    held = [(len(packed), size) for block in fitted._blocks for packed, size in forest._opened(block)]
    assert len(held) == 5 and sum(size for _, size in held) == fitted._bytes < fitted.totalNumNodes * 12 + 5 * 1000
    assert not any(hasattr(block, "_value") for block in fitted._blocks)


def test_forest_is_as_good_as_sparks(spark, rows):
    later = spark.createDataFrame(list(made_rows(1500, seed=2)), ["customer_id", "label", "features"])
    theirs = RandomForestClassifier(numTrees=200, maxDepth=30, seed=1).fit(rows)
    own = model.train_random_forest(rows)
    area = lambda m, df: model.roc_auc(model.predict_probability(m, df)).first().auc
    assert area(own, later) == pytest.approx(area(theirs, later), abs=0.02)
    assert area(own, rows) > 0.98
    assert own.totalNumNodes == pytest.approx(theirs.totalNumNodes, rel=0.1)
    assert np.allclose(own.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.05)
    found = own.transform(later).select("probability", "rawPrediction", "prediction", "customer_id").collect()
    assert len(found) == 1500
    for r in found:
        assert sum(r.probability) == pytest.approx(1) and sum(r.rawPrediction) == pytest.approx(200)
        assert r.prediction == (r.probability[1] > 0.5)


def test_forest_does_not_follow_the_session(rows):
    one, two = (model.predict_probability(model.train_random_forest(rows, trees=3), rows) for _ in range(2))
    assert one.join(two.select("customer_id", F.col("churn_probability").alias("q")), "customer_id").filter("churn_probability <> q").count() == 0


def test_mean_of_trees_by_hand(rows):
    """The score of a row is the mean of the shares in the leaves it falls into."""
    fitted = model.train_random_forest(rows, trees=7)
    trees = [forest._unpacked(*t) for block in fitted._blocks for t in forest._opened(block)]
    for r in model.predict_probability(fitted, rows.limit(50)).collect():
        total = 0
        for t in trees:
            at = 0
            while t["feature"][at] >= 0:
                i = t["feature"][at]
                at = t["child"][at] + (sum(c < r.features[int(i)] for c in fitted._thresholds[i]) > t["cut"][at])
            total += t["share"][t["child"][at]]
        assert r.churn_probability == pytest.approx(total / 7, abs=1e-12)


def test_blocks_read_again_and_nodes_in_parts_give_the_same_tree(monkeypatch):
    blocks = blocks_of()
    kept = [forest.grow_tree(blocks, 6, 701, 30, 3, 42, i) for i in range(3)]
    assert not same(kept[0], kept[1]) and len(kept[0]["feature"]) > 50
    monkeypatch.setattr(forest, "KEEP_BYTES", 0)
    monkeypatch.setattr(forest, "NODES_AT_ONCE", 5)
    assert all(same(forest.grow_tree(blocks, 6, 701, 30, 3, 42, i), tree) for i, tree in enumerate(kept))


def test_rows_end_in_leaves_of_their_own_counts():
    """With all inputs tried, distinct rows are told apart; the worth of the nodes is the impurity lost."""
    x = np.arange(32, dtype=np.uint8).reshape(-1, 1).repeat(2, axis=1)
    block = SimpleNamespace(value=(x, (np.arange(32) % 2).astype(np.uint8)))
    tree = forest.grow_tree([block], 2, 32, 30, 2, 7, 0)
    weight = np.random.default_rng([7, 0, 0]).poisson(1.0, 32)
    drawn = weight > 0
    assert np.array_equal(forest.tree_shares(tree, x)[drawn], (np.arange(32) % 2)[drawn])
    p = np.bincount(np.arange(32) % 2, weights=weight) / weight.sum()
    assert tree["worth"].sum() == pytest.approx(weight.sum() * (1 - (p**2).sum()))
    assert len(forest.grow_tree([block], 2, 32, 0, 2, 7, 0)["feature"]) == 1
    assert len(forest.grow_tree([block], 2, 32, 1, 2, 7, 0)["feature"]) <= 3


def test_best_split_against_all_splits():
    part = forest._Part(blocks_of(sizes=(300,))[0], np.random.default_rng(5), True)
    part.at = (np.arange(len(part.y)) % 3).astype(np.int32)
    tried = np.array([[0, 2], [5, 1], [3, 4]], np.int32)
    gain, feature, cut, left, right = forest._best_splits([part], 0, tried)

    def impurity(mine):
        w = np.bincount(part.y[mine], weights=part.weight[mine], minlength=2)
        return (w.sum() - (w**2).sum() / w.sum()) if w.sum() else 0.0, w

    for node in range(3):
        mine = part.at == node
        whole, w = impurity(mine)
        best = max((whole - impurity(mine & low)[0] - impurity(mine & ~low)[0]) / w.sum() for f in tried[node] for c in range(31) for low in [part.kept[:, f] <= c])
        assert gain[node] == pytest.approx(best, abs=1e-12)
        low = part.kept[:, feature[node]] <= cut[node]
        assert np.array_equal(left[node], impurity(mine & low)[1]) and np.array_equal(right[node], impurity(mine & ~low)[1])


def test_siblings_that_predict_alike_are_merged():
    leaf = np.full(2, -1, np.int32)
    zero = np.zeros(2, np.uint8)
    root = (np.array([0], np.int32), np.array([3], np.uint8), np.array([0.1]), np.array([[6.0, 3.0]]))
    tree = forest._pruned([root, (leaf, zero, np.zeros(2), np.array([[4.0, 1.0], [2.0, 2.0]]))])
    assert tree["feature"].tolist() == [-1] and tree["share"].tolist() == [1 / 3] and tree["worth"].sum() == 0
    tree = forest._pruned([root, (leaf, zero, np.zeros(2), np.array([[5.0, 1.0], [1.0, 2.0]]))])
    assert tree["feature"].tolist() == [0, -1, -1] and tree["child"][0] == 1


def test_thresholds():
    cuts = lambda values: forest.split_thresholds(*map(np.asarray, np.unique(values, return_counts=True)))
    assert cuts([1.0]) == [] and cuts([0.0, 1.0, 1.0]) == [0.5]
    assert cuts(np.arange(32.0)) == [i + 0.5 for i in range(31)]
    assert len(cuts(np.arange(1000.0))) == 31


def test_sketch_keeps_ranks():
    values = np.random.default_rng(1).permutation(600_000).astype(float)
    sketch = forest._Sketch()
    for part in np.array_split(values, 60):
        sketch.add(part)
    points, counts = sketch.points()
    assert len(points) <= forest.POINTS and counts.sum() == 600_000
    assert np.abs(np.cumsum(counts) - points).max() < 600_000 / 500


@pytest.mark.parametrize("bad", [("a", 2, Vectors.dense([1.0])), ("a", None, Vectors.dense([1.0])), ("a", 1, Vectors.dense([float("nan")]))])
def test_rows_it_cannot_learn_from(spark, bad):
    df = spark.createDataFrame([("z", 0, Vectors.dense([0.0])), bad], ["customer_id", "label", "features"])
    with pytest.raises(Exception, match="labels must be|features must not"):
        model.train_random_forest(df, trees=2)


def test_no_rows_one_class_and_a_constant_input(spark):
    df = spark.createDataFrame([(f"c{i}", 1, Vectors.sparse(2, {0: float(i)})) for i in range(9)], ["customer_id", "label", "features"])
    with pytest.raises(ValueError, match="rows"):
        model.train_random_forest(df.limit(0), trees=2)
    fitted = model.train_random_forest(df, trees=2)
    assert fitted.totalNumNodes == 2 and fitted.featureImportances.toArray().tolist() == [0, 0]
    assert {r.churn_probability for r in model.predict_probability(fitted, df).collect()} == {1.0}
    mixed = df.withColumn("label", (F.col("customer_id") > "c4").cast("int"))
    assert model.train_random_forest(mixed, trees=20).featureImportances.toArray().tolist() == [1, 0]


def test_comparison_keeps_the_forest_out_of_the_driver(rows, monkeypatch):
    seen, together = {}, model.together
    monkeypatch.setattr(model, "together", lambda jobs: seen.update(together(jobs)) or seen)
    few = {"Gradient Boosting": lambda t: model.train_gbt(t, 2), "Random Forest": lambda t: model.train_random_forest(t, 20)}
    monkeypatch.setattr(model, "LEARNERS", {**model.LEARNERS, **few})
    compared = model.compare_models(rows.withColumn("is_test", F.col("customer_id").endswith("7")))
    areas = {r.model: r.auc for r in compared.collect()}
    assert set(areas) == set(seen) == {"Logistic Regression", "Gradient Boosting", "Random Forest"}
    assert not isinstance(seen["Random Forest"], JavaModel) and areas["Random Forest"] > 0.8
