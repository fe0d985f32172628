"""Upgrade prediction on ``pyspark.ml``: encoding, two kinds of model, and their report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageloom.functions.lineage import shared_folder, written
from usageloom.operators.features import LABEL, stratified_split

NUMERIC = (
    "total_events",
    "distinct_features",
    "login_count",
    "logout_count",
    "feature_used_count",
)
CATEGORICAL = ("plan_tier", "country")


def encode(features: DataFrame, categorical: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """Adds the vector ``x``: numeric columns, then one column per category level but the first.

    A missing category encodes to zeros, as the first level does, so it is
    replaced by that level. Levels are taken from all rows, before any split.
    """
    first_level = {
        c: F.coalesce(F.col(c), features.select(F.min(c)).scalar()) for c in categorical
    }
    filled = features.withColumns({f"{c}_level": level for c, level in first_level.items()})
    stages = [
        # descending order makes the alphabetically first level the last index,
        # which is the one the encoder drops
        StringIndexer(
            inputCols=[f"{c}_level" for c in categorical],
            outputCols=[f"{c}_index" for c in categorical],
            stringOrderType="alphabetDesc",
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categorical],
            outputCols=[f"{c}_is" for c in categorical],
            dropLast=True,
        ),
        VectorAssembler(
            inputCols=[*NUMERIC, *[f"{c}_is" for c in categorical]], outputCol="x"
        ),
    ]
    helpers = [f"{c}_{suffix}" for c in categorical for suffix in ("level", "index", "is")]
    return Pipeline(stages=stages).fit(filled).transform(filled).drop(*helpers)


def feature_names(encoded: DataFrame) -> list[str]:
    """Names of the elements of ``x``, such as ``login_count`` or ``country_FR``."""
    attributes = encoded.schema["x"].metadata["ml_attr"]["attrs"]
    found = [a for group in attributes.values() for a in group]
    names = [a["name"] for a in sorted(found, key=lambda a: a["idx"])]
    return [n.replace("_is_", "_", 1) for n in names]


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    names: list[str]


def prepare(features: DataFrame, label: str = LABEL, seed: int = 42) -> Prepared:
    """Encoded features, split 75/25 by label, both written since every fit makes many passes."""
    encoded = encode(written(features, "features")).withColumn("label", F.col(label).cast("double"))
    split = written(stratified_split(encoded, label=label, seed=seed), "split")
    return Prepared(
        train=split.filter(F.col("split") == "train"),
        test=split.filter(F.col("split") == "test"),
        names=feature_names(encoded),
    )


def fit_scaler(train: DataFrame) -> PipelineModel:
    """Centres and scales ``x`` to unit population deviation, learned from the training rows."""
    n = train.count()
    # the library divides by the sample deviation; this factor turns it into the population one
    correction = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    scaler = StandardScaler(inputCol="x", outputCol="x_sample", withMean=True, withStd=True).fit(train)
    factor = ElementwiseProduct(
        inputCol="x_sample",
        outputCol="x_scaled",
        scalingVec=Vectors.dense([correction] * len(scaler.mean)),
    )
    return PipelineModel(stages=[scaler, factor])


def stored(model: PipelineModel, train: DataFrame) -> PipelineModel:
    """The model written to the shared folder and read back.

    A freshly fitted model carries its training summary and with it the
    session, which cannot be sent to tasks once the session has observed
    metrics. The stored model is free of it and outlives the driver.
    """
    path = shared_folder(train.sparkSession, "model")
    model.write().save(path)
    return PipelineModel.load(path)


def train_logistic(train: DataFrame) -> PipelineModel:
    """L2-regularised logistic regression of unit inverse strength on scaled features."""
    scaler = fit_scaler(train)
    model = LogisticRegression(
        featuresCol="x_scaled",
        labelCol="label",
        maxIter=1000,
        # the library averages the loss over rows, hence strength per row
        regParam=1.0 / train.count(),
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-8,
    ).fit(scaler.transform(train))
    return stored(PipelineModel(stages=[*scaler.stages, model]), train)


INTERCEPT = "(intercept)"


def coefficients(spark, model: PipelineModel, names: list[str]) -> DataFrame:
    """``feature`` and ``coefficient`` on the scaled features, the intercept among them."""
    fitted = model.stages[-1]
    values = [*(float(c) for c in fitted.coefficients), float(fitted.intercept)]
    return spark.createDataFrame(list(zip([*names, INTERCEPT], values)), "feature string, coefficient double")


def fitted_moments(model: PipelineModel, train: DataFrame, names: list[str]) -> DataFrame:
    """Per feature the sum of probability times value plus the penalty's pull: the certificate of a fit.

    At the optimum, and only there since the loss is convex, it equals the sum of label times value.
    """
    fitted = model.stages[-1]
    scored = model.transform(train).select(
        vector_to_array("probability")[1].alias("p"), vector_to_array("x_scaled").alias("v"))
    sums = [F.sum(F.col("p") * F.col("v")[i]) + F.lit(float(c)) for i, c in enumerate(fitted.coefficients)]
    cells = [F.struct(F.lit(n).alias("feature"), s.alias("moment")) for n, s in zip([*names, INTERCEPT], [*sums, F.sum("p")])]
    return scored.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def balanced_weights(train: DataFrame) -> DataFrame:
    """``weight`` = rows / (labels * rows of the label); one row per label is broadcast."""
    per_label = train.groupBy("label").agg(F.count("*").alias("_n"))
    overall = per_label.agg(F.sum("_n").alias("total"), F.count("*").alias("labels"))
    total, labels = overall.select("total").scalar(), overall.select("labels").scalar()
    weights = per_label.select("label", (total / (labels * F.col("_n"))).alias("weight"))
    return train.join(F.broadcast(weights), "label")


def train_forest(train: DataFrame, balanced: bool = False, seed: int = 42) -> PipelineModel:
    """100 trees of depth 5 on unscaled features, optionally with balanced label weights."""
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=100, maxDepth=5, seed=seed
    )
    if balanced:
        forest = forest.setWeightCol("weight")
        train = balanced_weights(train)
    return stored(PipelineModel(stages=[forest.fit(train)]), train)


def predict(model: PipelineModel, test: DataFrame) -> DataFrame:
    return model.transform(test).select(
        "user_id",
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def feature_importances(
    spark, model: PipelineModel, names: list[str], top: int = 10
) -> DataFrame:
    """The most important features of a forest; the vector has one entry per encoded column."""
    importances = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(names, importances)]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )


def confusion_cells(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(predictions: DataFrame, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """All label and prediction pairs, empty ones with 0; a single pass with one counter per pair."""
    pairs = [(actual, guess) for actual in classes for guess in classes]
    counted = predictions.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("label"),
                    F.lit(g).alias("prediction"),
                    F.count_if((F.col("label") == a) & (F.col("prediction") == g)).alias("n"),
                )
                for a, g in pairs
            ]
        ).alias("cells")
    )
    return counted.select(F.explode("cells").alias("c")).select("c.*")


def _zero_safe(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    Ratios with a zero denominator are 0. Computed from the label and
    prediction counts alone, so the predictions are read once.
    """
    cells = confusion_cells(predictions)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    per_class = (
        cells.select(F.explode(sides).alias("s"))
        .groupBy("s.class")
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.predicted").alias("predicted"),
            F.sum("s.hits").alias("hits"),
        )
        .withColumn("precision", _zero_safe(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _zero_safe(F.col("hits"), F.col("support")))
        .withColumn(
            "f1",
            _zero_safe(2 * F.col("hits"), F.col("support") + F.col("predicted")),
        )
    )
    scores = ("precision", "recall", "f1")
    means = per_class.agg(
        _zero_safe(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[_zero_safe(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"weighted_{s}") for s in scores],
    )

    def line(name: str, prefix: str | None):
        columns = [
            F.col("accuracy") if prefix is None else F.col(f"{prefix}_{s}") for s in scores
        ]
        return F.struct(
            F.lit(name).alias("class"),
            *[c.alias(s) for c, s in zip(columns, scores)],
            F.col("support").alias("support"),
        )

    summary = means.select(
        F.explode(
            F.array(line("accuracy", None), line("macro avg", "macro"), line("weighted avg", "weighted"))
        ).alias("l")
    ).select("l.*")
    return per_class.select(F.col("class").cast("string").alias("class"), *scores, "support").unionByName(summary)


def headline_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the positive class, in one pass."""
    actual, guess = F.col("label") == 1, F.col("prediction") == 1
    return predictions.agg(
        F.count_if(F.col("label") == F.col("prediction")).alias("right"),
        F.count("*").alias("n"),
        F.count_if(actual & guess).alias("hits"),
        F.count_if(guess).alias("guessed"),
        F.count_if(actual).alias("positives"),
    ).select(
        _zero_safe(F.col("right"), F.col("n")).alias("accuracy"),
        _zero_safe(F.col("hits"), F.col("guessed")).alias("precision"),
        _zero_safe(F.col("hits"), F.col("positives")).alias("recall"),
        _zero_safe(2 * F.col("hits"), F.col("guessed") + F.col("positives")).alias("f1"),
    )
