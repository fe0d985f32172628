"""Split sizes, encoding, scaling, the two models and their report."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from usageloom.operators import features, upgrade_model


def users(spark, n, positives):
    return spark.range(n).select(
        F.concat(F.lit("u"), "id").alias("user_id"),
        F.when(F.col("id") < positives, 1).otherwise(0).alias("upgraded"),
        F.col("id").alias("payload"),
    )


@pytest.mark.parametrize("n,positives", [(100, 5), (101, 40), (7, 3), (1000, 999), (10, 10), (3, 1), (1, 1)])
def test_split_is_exact_per_label(spark, n, positives):
    got = features.stratified_split(users(spark, n, positives)).collect()
    assert len(got) == n
    n_test = math.ceil(n * 0.25)
    n_train = n - n_test
    counts = {1: positives, 0: n - positives}
    # the whole parts, then one more for the largest remainders
    train = {c: k * n_train // n for c, k in counts.items()}
    left = n_train - sum(train.values())
    for c in sorted(counts, key=lambda c: (-(counts[c] * n_train % n), c))[:left]:
        train[c] += 1
    for label, k in counts.items():
        tests = [r for r in got if r["upgraded"] == label and r["split"] == "test"]
        assert len(tests) == k - train[label]
    assert sum(r["split"] == "test" for r in got) == n_test


def test_split_equals_ranking_every_label(spark):
    import hashlib

    got = {r["user_id"]: r["split"] for r in features.stratified_split(users(spark, 500, 120)).collect()}
    for low, high in ((0, 120), (120, 500)):
        names = [f"u{i}" for i in range(low, high)]
        ranked = sorted(names, key=lambda u: hashlib.md5(f"{u}-42".encode()).hexdigest())
        n_test = sum(got[u] == "test" for u in names)
        assert {u for u in names if got[u] == "test"} == set(ranked[:n_test])


def test_split_never_ranks_a_whole_label(spark):
    split = features.stratified_split(users(spark, 1000, 500))
    for line in split._jdf.queryExecution().optimizedPlan().toString().splitlines():
        assert "payload" not in line or "row_number" not in line


ROWS = [
    ("a", 10, 3, 2, 1, 5, "free", "US", 1),
    ("b", 4, 1, 1, 1, 1, "basic", "DE", 0),
    ("c", 7, 2, 2, 2, 3, "pro", None, 1),
    ("d", 2, 0, 1, 0, 0, "free", "AU", 0),
]
COLUMNS = (
    "user_id string, total_events bigint, distinct_features bigint, login_count bigint,"
    " logout_count bigint, feature_used_count bigint, plan_tier string, country string, upgraded int"
)


def test_encoding_drops_the_first_level(spark):
    encoded = upgrade_model.encode(spark.createDataFrame(ROWS, COLUMNS))
    names = upgrade_model.feature_names(encoded)
    assert set(names) == {*upgrade_model.NUMERIC, "plan_tier_free", "plan_tier_pro", "country_DE", "country_US"}
    got = {
        r["user_id"]: dict(zip(names, r["x"]))
        for r in encoded.select("user_id", vector_to_array("x").alias("x")).collect()
    }
    assert got["a"]["plan_tier_free"] == 1 and got["a"]["country_US"] == 1 and got["a"]["country_DE"] == 0
    assert got["b"]["plan_tier_free"] == got["b"]["plan_tier_pro"] == 0
    # a missing country and the first country are both all zeros
    assert all(got[u][c] == 0 for u in "cd" for c in ("country_DE", "country_US"))
    assert got["a"]["total_events"] == 10


def synthetic(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.poisson(5, size=(n, 5)).astype(float)
    tiers = rng.choice(["basic", "enterprise", "free", "pro"], n)
    countries = rng.choice(["AU", "BR", "US"], n)
    y = (x[:, 0] + 2 * (tiers == "pro") + rng.normal(0, 2, n) > 6).astype(int)
    rows = [(f"u{i}", *map(int, x[i]), str(tiers[i]), str(countries[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def prepared(spark):
    return upgrade_model.prepare(synthetic(spark))


def matrix(frame, column):
    rows = frame.select(vector_to_array(column).alias("x"), "label").collect()
    return np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])


def test_scaler_uses_population_deviation_of_training_rows(prepared):
    scaled = upgrade_model.fit_scaler(prepared.train).transform(prepared.train)
    x, _ = matrix(scaled, "x_scaled")
    raw, _ = matrix(prepared.train, "x")
    assert np.allclose(x.mean(0), 0, atol=1e-9)
    assert np.allclose(x.std(0), 1) and raw.std(0).min() > 0


def test_logistic_regression_reaches_the_penalised_optimum(prepared):
    model = upgrade_model.train_logistic(prepared.train)
    scaled = model.stages[1].transform(model.stages[0].transform(prepared.train))
    x, y = matrix(scaled, "x_scaled")
    # Newton's method on 0.5 |w|^2 + sum of losses, intercept free
    design = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - y) + ridge @ w
        w -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, gradient)
    fitted = model.stages[-1]
    assert np.allclose(fitted.coefficients.toArray(), w[:-1], atol=1e-4)
    assert abs(fitted.intercept - w[-1]) < 1e-4


def test_predicting_after_metrics_were_observed(spark, prepared):
    """An observed session cannot be shipped to tasks; stored models do not hold it."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    model = upgrade_model.train_logistic(prepared.train)
    got = upgrade_model.headline_metrics(upgrade_model.predict(model, prepared.test)).first()
    assert got["accuracy"] > 0.6


def test_forest_and_importances(spark, prepared):
    model = upgrade_model.train_forest(prepared.train)
    forest = model.stages[-1]
    assert forest.getNumTrees == 100 and max(t.depth for t in forest.trees) <= 5
    top = upgrade_model.feature_importances(spark, model, prepared.names).collect()
    assert len(top) == 10 and top[0]["feature"] == "total_events"
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)
    got = upgrade_model.headline_metrics(upgrade_model.predict(model, prepared.test)).first()
    assert got["accuracy"] > 0.6


def test_balanced_weights(prepared):
    weighted = upgrade_model.balanced_weights(prepared.train).groupBy("label").agg(
        F.count("*").alias("n"), F.max("weight").alias("w")
    ).collect()
    total = sum(r["n"] for r in weighted)
    for r in weighted:
        assert r["w"] == pytest.approx(total / (2 * r["n"]))
    model = upgrade_model.train_forest(prepared.train, balanced=True)
    assert upgrade_model.predict(model, prepared.test).count() == prepared.test.count()


def predictions(spark, cells):
    rows = [(f"{i}-{k}", a, g) for i, (a, g, n) in enumerate(cells) for k in range(n)]
    return spark.createDataFrame(rows, "user_id string, label int, prediction int")


def test_report(spark):
    frame = predictions(spark, [(1, 1, 6), (1, 0, 2), (0, 1, 1), (0, 0, 3)])
    got = {r["class"]: r for r in upgrade_model.classification_report(frame).collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["support"]) == (6 / 7, 6 / 8, 8)
    assert got["0"]["f1"] == pytest.approx(2 * 3 / (5 + 4))
    assert got["accuracy"]["f1"] == 9 / 12
    assert got["macro avg"]["precision"] == pytest.approx((6 / 7 + 3 / 5) / 2)
    assert got["weighted avg"]["recall"] == pytest.approx(9 / 12)
    head = upgrade_model.headline_metrics(frame).first()
    assert (head["accuracy"], head["precision"], head["recall"]) == (9 / 12, 6 / 7, 6 / 8)
    assert sorted(map(tuple, upgrade_model.confusion_matrix(frame).collect())) == [
        (0, 0, 3), (0, 1, 1), (1, 0, 2), (1, 1, 6),
    ]


def test_report_when_nothing_is_predicted_positive(spark):
    frame = predictions(spark, [(1, 0, 2), (0, 0, 8)])
    got = {r["class"]: r for r in upgrade_model.classification_report(frame).collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["f1"]) == (0.0, 0.0, 0.0)
    assert tuple(upgrade_model.headline_metrics(frame).first()) == (0.8, 0.0, 0.0, 0.0)


def test_report_of_a_single_class(spark):
    frame = predictions(spark, [(1, 1, 4)])
    got = {r["class"]: r for r in upgrade_model.classification_report(frame).collect()}
    assert set(got) == {"1", "accuracy", "macro avg", "weighted avg"}
    assert all(got[c]["f1"] == 1.0 for c in got)
    assert (0, 0, 0) in [tuple(r) for r in upgrade_model.confusion_matrix(frame).collect()]
