"""What a decision tree is made of: the exact best split as grouped sums, and a stored forest as a table of nodes."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom.functions.lineage import shared_folder
from usageloom.operators.upgrade_model import balanced_weights, stored

#: values of a feature whose running sums are made together
RANGE = 1024.0
#: gains closer than this many decimals are ties, which go to the earlier feature and the lower threshold
DECIMALS = 12

SPLIT = ("feature", "threshold", "gain", "left_rows", "right_rows", "left_0", "left_1", "right_0", "right_1")


def gini(zero: Column, one: Column) -> Column:
    whole = zero + one
    return F.when(whole > 0, 1 - (zero / whole) ** 2 - (one / whole) ** 2).otherwise(0.0)


def value_counts(train: DataFrame, names: list[str]) -> DataFrame:
    """Rows and label weights per feature and value: the one pass over the data."""
    weight = F.col("weight") if "weight" in train.columns else F.lit(1.0)
    values = vector_to_array("x")
    cells = F.array(*[F.struct(F.lit(i).alias("at"), values[i].alias("value")) for i in range(len(names))])
    return (
        train.select("label", weight.alias("weight"), F.explode(cells).alias("c"))
        .groupBy("c.at", "c.value")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.when(F.col("label") == 0, F.col("weight")).otherwise(0.0)).alias("zero"),
            F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0.0)).alias("one"),
        )
    )


def split_gains(train: DataFrame, names: list[str]) -> DataFrame:
    """Every threshold between two neighbouring values of a feature, with its gain and both sides.

    Running sums come in two steps, over ranges of values and within each range, so that no
    task orders all values of a feature.
    """
    sums = ("n", "zero", "one")
    counts = value_counts(train, names).withColumn("range", F.floor(F.col("value") / RANGE))
    feature, before = W.partitionBy("at"), W.partitionBy("at").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = (
        counts.groupBy("at", "range")
        .agg(F.min("value").alias("first"), *[F.sum(c).alias(c) for c in sums])
        .select(
            "at", "range",
            F.lead("first").over(feature.orderBy("range")).alias("after"),
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums],
            *[F.sum(c).over(feature).alias(f"{c}_all") for c in sums],
        )
    )
    within = W.partitionBy("at", "range").orderBy("value")
    upto = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    left = {c: F.col(f"{c}_before") + F.sum(c).over(upto) for c in sums}
    sides = counts.join(ranges, ["at", "range"]).select(
        "at",
        "value",
        F.coalesce(F.lead("value").over(within), "after").alias("next"),
        *[left[c].alias(f"{c}_left") for c in sums],
        *[(F.col(f"{c}_all") - left[c]).alias(f"{c}_right") for c in sums],
    )
    l0, l1, r0, r1 = (F.col(c) for c in ("zero_left", "one_left", "zero_right", "one_right"))
    whole = l0 + l1 + r0 + r1
    gain = gini(l0 + r0, l1 + r1) - (l0 + l1) / whole * gini(l0, l1) - (r0 + r1) / whole * gini(r0, r1)
    return sides.filter(F.col("next").isNotNull()).select(
        "at",
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("at") + 1).alias("feature"),
        ((F.col("value") + F.col("next")) / 2).alias("threshold"),
        gain.alias("gain"),
        F.col("n_left").alias("left_rows"), F.col("n_right").alias("right_rows"),
        l0.alias("left_0"), l1.alias("left_1"), r0.alias("right_0"), r1.alias("right_1"),
    )


def best_split(train: DataFrame, names: list[str]) -> DataFrame:
    """The split of the highest gain; no row where no feature has two values."""
    order = [F.desc(F.round("gain", DECIMALS)), F.asc("at"), F.asc("threshold")]
    return split_gains(train, names).orderBy(*order).limit(1).select(*SPLIT)


def train_stump(train: DataFrame, names: list[str], balanced: bool = False, depth: int = 1) -> PipelineModel:
    """The library's forest as one tree over all rows and all features, with a threshold between any two values."""
    per_feature = value_counts(train, names).groupBy("at").agg(F.count("*").alias("n"))
    most = per_feature.agg(F.max("n")).first()[0] or 1
    tree = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=1, maxDepth=depth, bootstrap=False,
        featureSubsetStrategy="all", maxBins=most + 1, seed=42,
    )
    if balanced:
        tree = tree.setWeightCol("weight")
        train = balanced_weights(train)
    return stored(PipelineModel(stages=[tree.fit(train)]), train)


def node_table(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes of a forest as it is stored: tree, node, children, weight, impurity, gain and split."""
    path = shared_folder(spark, "forest")
    model.stages[-1].write().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["rawCount"].alias("rows"),
        node["impurityStats"].alias("weights"),
        F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x).alias("weight"),
        # from the label weights, since the library leaves it out where it did not try to split
        gini(node["impurityStats"][0], node["impurityStats"][1]).alias("impurity"),
        node["gain"].alias("gain"),
        F.when(node["leftChild"] >= 0, node["split"]["featureIndex"]).alias("at"),
        F.when(node["leftChild"] >= 0, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
    )


def root_split(nodes: DataFrame, names: list[str]) -> DataFrame:
    """The first split of a one-tree forest in the columns of :func:`best_split`."""
    kept = nodes.select("node", "rows", "weights")
    left = kept.select(F.col("node").alias("left"), F.col("rows").alias("left_rows"), F.col("weights").alias("_l"))
    right = kept.select(F.col("node").alias("right"), F.col("rows").alias("right_rows"), F.col("weights").alias("_r"))
    root = nodes.filter((F.col("node") == 0) & (F.col("left") >= 0))
    return root.join(left, "left").join(right, "right").select(
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("at") + 1).alias("feature"),
        "threshold", "gain", "left_rows", "right_rows",
        F.col("_l")[0].alias("left_0"), F.col("_l")[1].alias("left_1"),
        F.col("_r")[0].alias("right_0"), F.col("_r")[1].alias("right_1"),
    )


def node_importances(nodes: DataFrame, names: list[str]) -> DataFrame:
    """``feature``, ``decrease`` and ``importance`` from the nodes alone, features without a split included.

    A split takes impurity from its rows: the impurity of its node times the node's weight, less the
    same of both children. Those of one tree are shares of the tree's sum; the shares of all trees that split
    at all are added and shared out again.
    """
    child = nodes.select("tree", F.col("node").alias("child"), (F.col("impurity") * F.col("weight")).alias("rest"))
    taken = (
        nodes.filter(F.col("left") >= 0)
        .select("tree", "node", "at", (F.col("impurity") * F.col("weight")).alias("own"), F.explode(F.array("left", "right")).alias("child"))
        .join(child, ["tree", "child"])
        .groupBy("tree", "node", "at", "own")
        .agg(F.sum("rest").alias("rest"))
        .groupBy("tree", "at")
        .agg(F.sum(F.col("own") - F.col("rest")).alias("decrease"))
    )
    shares = taken.withColumn("share", F.try_divide("decrease", F.sum("decrease").over(W.partitionBy("tree"))))
    per_feature = shares.groupBy("at").agg(F.sum("decrease").alias("decrease"), F.sum("share").alias("share"))
    whole = per_feature.select(F.sum("share").alias("whole"))
    spark = nodes.sparkSession
    features = spark.createDataFrame(list(enumerate(names)), "at int, feature string")  # one row per feature
    return features.join(F.broadcast(per_feature), "at", "left").select(
        "feature",
        F.coalesce("decrease", F.lit(0.0)).alias("decrease"),
        F.coalesce(F.try_divide(F.col("share"), whole.scalar()), F.lit(0.0)).alias("importance"),
    )
