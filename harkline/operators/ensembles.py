"""Fitted tree ensembles as tables, and what their first rounds alone would say."""

from __future__ import annotations

import json
from collections.abc import Sequence
from uuid import uuid4

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from harkline.operators.boosting import LEARNING_RATE, Tree
from harkline.operators.frozen import freeze
from harkline.session import tables_dir

# Rows that the form of a stored model is taken from.
FORM_ROWS = 100


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model that a fit of ``rounds`` rounds with the same settings gives.

    Boosting adds one tree a round and never changes earlier ones, so the first trees of a long fit are the short fit.
    """
    trees, weights = model.trees, model.treeWeights
    if rounds >= len(trees):
        return model
    gateway = SparkSession.active().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    kept, weighed = gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        kept[i], weighed[i] = trees[i]._java_obj, float(weights[i])
    return GBTClassificationModel(ml.classification.GBTClassificationModel(model.uid, kept, weighed))


def boosted_model(learner: GBTClassifier, trees: Sequence[Tree], splits: Sequence[np.ndarray], rows: DataFrame) -> GBTClassificationModel:
    """The model of grown ``trees`` with the settings of ``learner``, as if it had fitted them; splits are the thresholds of each feature.

    Written down as the library writes a model, whose form is taken from a fit of one round on a few of ``rows``, and loaded.
    """
    spark = rows.sparkSession
    path, form = f"{tables_dir(spark)}/{uuid4().hex}", f"{tables_dir(spark)}/{uuid4().hex}"
    learner.copy({learner.maxIter: 1}).fit(rows.limit(FORM_ROWS)).write().save(form)
    about = json.loads(spark.read.text(f"{form}/metadata").head()[0])
    about["paramMap"]["maxIter"], about["numTrees"], about["numFeatures"] = learner.getMaxIter(), len(trees), len(splits)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    tree, weight = (c for c in spark.read.parquet(f"{form}/treesMetadata").columns if c != "_1")
    one = spark.read.parquet(f"{form}/treesMetadata")
    weights = F.when(F.col("id") == 0, 1.0).otherwise(LEARNING_RATE)
    one.crossJoin(spark.range(len(trees), numPartitions=1)).select(F.col("id").cast("int").alias("_1"), tree, weights.alias(weight)).coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(i, node) for i, tree in enumerate(trees) for node in _node_rows(tree, splits)]
    spark.createDataFrame(nodes, spark.read.parquet(f"{form}/data").schema).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def _node_rows(tree: Tree, splits: Sequence[np.ndarray]) -> list[tuple]:
    """The nodes of a tree from the root, each before those below it, as the library stores them; equal leaves of one split are one."""
    rows: list[tuple] = []

    def impurity(stats: np.ndarray) -> float:
        return float((stats[2] - stats[1] ** 2 / stats[0]) / stats[0]) if stats[0] else 0.0

    def add(node: int) -> tuple[np.ndarray, float, bool]:
        """Statistics and value of a node, and whether it is a leaf."""
        at, value = len(rows), float(tree.value[node])
        rows.append(())
        stats, gain, left, right, split = tree.leaves[:, node], -1.0, -1, -1, (-1, [], -1)
        if (feature := int(tree.feature[node])) >= 0:
            left = len(rows)
            below, said, is_leaf = add(2 * node)
            right = len(rows)
            other, says, other_leaf = add(2 * node + 1)
            stats = below + other
            gain = impurity(stats) - below[0] / stats[0] * impurity(below) - other[0] / stats[0] * impurity(other)
            split = (feature, [float(splits[feature][tree.bin[node]])], -1)
            if is_leaf and other_leaf and said == says:
                del rows[at + 1 :]
                gain, left, right, split, value = -1.0, -1, -1, (-1, [], -1), said
        rows[at] = (at, value, impurity(stats), [float(s) for s in stats], int(stats[0]), float(gain), left, right, split)
        return stats, value, left < 0

    add(1)
    return rows


def tree_table(model: Model) -> DataFrame:
    """``(tree, node, feature, threshold, left, right, value, leaf_counts, weight)``: the nodes of a forest or boosted model.

    Read from what the model writes when it is saved. Node 0 is a root; a leaf has a null ``feature``. Features are
    numbers, so a row goes left where its feature is at most ``threshold``. ``value`` is a leaf's prediction, ``leaf_counts`` its rows by class
    (one entry with squared errors for boosted trees), and ``weight`` that of the tree.
    """
    spark = SparkSession.active()
    path = f"{tables_dir(spark)}/{uuid4().hex}"
    model.write().save(path)
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, node["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"),
        F.when(~inner, node["prediction"]).alias("value"), F.when(~inner, node["impurityStats"]).alias("leaf_counts"),
    )
    return freeze(nodes.join(F.broadcast(weights), "tree"))


def leaves_reached(nodes: DataFrame, rows: DataFrame, keys: Sequence[str], features: str = "features", leaf: bool = False) -> DataFrame:
    """``(*keys, tree, value, leaf_counts, weight)``: the leaf of each tree that a row of vectors ends in; ``node`` as well if ``leaf``.

    One join with the nodes per level. The nodes are those of one model, so they are broadcast; rows times trees
    are narrow and never shuffled.
    """
    deepest = _depth(nodes)
    values = vector_to_array(F.col(features))
    last = nodes.agg(F.max("tree")).head()[0]
    at = rows.select(*keys, values.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(last))).alias("tree")).withColumn("node", F.lit(0))
    for _ in range(deepest):
        step = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(F.broadcast(nodes.select("tree", "node", "feature", "threshold", "left", "right")), ["tree", "node"])
        at = at.select(*keys, "_x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(step).alias("node"))
    return at.join(F.broadcast(nodes), ["tree", "node"]).select(*keys, "tree", *(["node"] if leaf else []), "value", "leaf_counts", "weight")


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots, from the parents of the nodes; a tree has a few levels."""
    kids = freeze(
        nodes.filter("feature IS NOT NULL").select("tree", "node", F.explode(F.array("left", "right")).alias("kid"))
    )
    level, depth = kids.filter("node = 0"), 0
    while not level.isEmpty():
        depth += 1
        below = level.select("tree", F.col("kid").alias("node"))
        level = freeze(kids.join(F.broadcast(below), ["tree", "node"]))
    return depth


def boosted_margin(leaves: DataFrame, keys: Sequence[str], rounds: int | None = None) -> DataFrame:
    """``(*keys, margin)``: the weighted sum of the leaves, of the first ``rounds`` trees if given."""
    leaves = leaves if rounds is None else leaves.filter(F.col("tree") < rounds)
    return leaves.groupBy(*keys).agg(F.sum(F.col("weight") * F.col("value")).alias("margin"))


def forest_votes(leaves: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, at, share)``: the mean over all trees of the share of each class in the leaf; ``at`` is the class."""
    total = F.aggregate("leaf_counts", F.lit(0.0), lambda a, b: a + b)
    votes = leaves.select(*keys, "tree", total.alias("_total"), F.posexplode("leaf_counts").alias("at", "_n"))
    return votes.groupBy(*keys, "at").agg(F.avg(F.col("_n") / F.col("_total")).alias("share"))


def leaf_errors(nodes: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(tree, leaf, n_rows, value, expected)`` of a boosted model and the rows it was fitted on, without subsampling.

    A leaf's value is the mean of what its round set out to fit, over the rows that reach it: the signs of the classes in the first
    round, and then the negative slopes of the loss 2 log(1 + exp(-2 y F)) at the margin F of the rounds before. Margins of all rounds
    are running sums along each row's leaves.
    """
    labels = rows.select(*keys, F.when(F.col("class") == 1, 1.0).otherwise(-1.0).alias("_y"))
    leaves = freeze(leaves_reached(nodes, rows, keys, leaf=True))
    before = Window.partitionBy(*keys).orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    margin = F.sum(F.col("weight") * F.col("value")).over(before)
    y = F.col("_y")
    asked = F.when(F.col("tree") == 0, y).otherwise(4 * y / (1 + F.exp(2 * y * F.col("_margin"))))
    reached = leaves.withColumn("_margin", margin).join(labels, list(keys))
    return reached.groupBy("tree", F.col("node").alias("leaf")).agg(F.count(F.lit(1)).alias("n_rows"), F.any_value("value").alias("value"), F.avg(asked).alias("expected"))
