"""Split search against enumeration and the library, importances of whole forests against the library's vector."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from conftest import MEDIUM
from usageloom.operators import trees, upgrade_model
from usageloom.plans.registry import _prepared


def frame(spark, x, y, weights=None):
    rows = [(Vectors.dense(v), float(k), float(w)) for v, k, w in zip(x, y, weights if weights is not None else [1.0] * len(y))]
    made = spark.createDataFrame(rows, ["x", "label", "weight"])
    return made if weights is not None else made.drop("weight")


def gini(a, b):
    return 1 - (a / (a + b)) ** 2 - (b / (a + b)) ** 2 if a + b else 0.0


def brute(x, y, w):
    best = None
    total = [w[y == k].sum() for k in (0, 1)]
    for at in range(x.shape[1]):
        values = np.unique(x[:, at])
        for lower, upper in zip(values, values[1:]):
            here = x[:, at] <= lower
            left = [w[here & (y == k)].sum() for k in (0, 1)]
            right = [t - c for t, c in zip(total, left)]
            gain = gini(*total) - sum(left) / w.sum() * gini(*left) - sum(right) / w.sum() * gini(*right)
            found = (-round(gain, 12), at, (lower + upper) / 2, int(here.sum()), int((~here).sum()), *left, *right)
            best = found if best is None or found[:3] < best[:3] else best
    return best


@pytest.mark.parametrize("seed", range(4))
def test_best_split_equals_enumeration_over_ranges_and_ties(spark, monkeypatch, seed):
    monkeypatch.setattr(trees, "RANGE", 3.0)
    draw = np.random.default_rng(seed)
    x = draw.integers(-9, 9, (60, 3)) * draw.choice([0.5, 1.0, 2.5], 3)
    x = np.column_stack([x, x[:, 1]])  # the last feature ties with the second
    y = draw.integers(0, 2, 60)
    w = draw.choice([0.5, 1.0, 3.0], 60)
    got = trees.best_split(frame(spark, x, y, w), ["a", "b", "c", "d"]).first()
    want = brute(x, y, w)
    assert (got["feature"], got["threshold"], got["left_rows"], got["right_rows"]) == ("abcd"[want[1]], *want[2:5])
    assert [got[c] for c in ("left_0", "left_1", "right_0", "right_1")] == pytest.approx(want[5:])
    assert got["gain"] == pytest.approx(-want[0], abs=1e-9)


def test_no_split_where_no_feature_varies(spark):
    assert trees.best_split(frame(spark, np.ones((5, 2)), np.array([0, 1, 0, 1, 1])), ["a", "b"]).collect() == []
    assert trees.best_split(frame(spark, np.ones((5, 2)), np.zeros(5)).limit(0), ["a", "b"]).collect() == []


@pytest.fixture(scope="module")
def data(spark):
    return _prepared(spark, MEDIUM)


@pytest.mark.parametrize("balanced", [False, True])
def test_search_equals_the_librarys_first_split(spark, data, balanced):
    train = upgrade_model.balanced_weights(data.train) if balanced else data.train
    mine = trees.best_split(train, data.names).first()
    nodes = trees.node_table(trees.train_stump(data.train, data.names, balanced), spark)
    theirs = trees.root_split(nodes, data.names).first()
    assert mine["feature"] == theirs["feature"]
    assert [mine[c] for c in trees.SPLIT[1:]] == pytest.approx([theirs[c] for c in trees.SPLIT[1:]])


@pytest.mark.parametrize("balanced", [False, True])
def test_importances_of_a_whole_forest_equal_the_librarys(spark, data, balanced):
    model = upgrade_model.train_forest(data.train, balanced)
    got = {r["feature"]: r["importance"] for r in trees.node_importances(trees.node_table(model, spark), data.names).collect()}
    want = model.stages[-1].featureImportances.toArray()
    assert [got[n] for n in data.names] == pytest.approx(list(want), abs=1e-9)
    assert sum(got.values()) == pytest.approx(1)


def test_a_forest_without_splits_has_no_importance(spark):
    rows = frame(spark, np.ones((6, 2)), np.array([0, 1, 0, 1, 1, 1]))
    nodes = trees.node_table(trees.train_stump(rows, ["a", "b"]), spark)
    assert [tuple(r) for r in trees.node_importances(nodes, ["a", "b"]).sort("feature").collect()] == [("a", 0.0, 0.0), ("b", 0.0, 0.0)]
    assert trees.root_split(nodes, ["a", "b"]).collect() == []


def test_moments_are_those_of_the_labels_at_the_optimum_only(spark, data):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression

    scaler = upgrade_model.fit_scaler(data.train)
    scaled = scaler.transform(data.train).select("x_scaled", "label").collect()
    observed = np.array([[*r["x_scaled"].toArray(), 1.0] for r in scaled]).T @ np.array([r["label"] for r in scaled])

    def moments(model):
        rows = upgrade_model.fitted_moments(model, data.train, data.names).collect()
        assert [r["feature"] for r in rows] == [*data.names, upgrade_model.INTERCEPT]
        return [r["moment"] for r in rows]

    assert moments(upgrade_model.train_logistic(data.train)) == pytest.approx(list(observed), abs=1e-4)
    early = LogisticRegression(featuresCol="x_scaled", labelCol="label", maxIter=1, standardization=False,
                               regParam=1.0 / data.train.count()).fit(scaler.transform(data.train))
    early = upgrade_model.stored(PipelineModel(stages=[*scaler.stages, early]), data.train)
    away = np.abs(np.array(moments(early)) - observed)
    assert away.max() > 0.1
