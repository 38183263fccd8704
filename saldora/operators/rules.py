"""Fitted trees as tables and expressions: export, scoring, replay of every split."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldora.operators.forest import ForestModel
from saldora.session import scratch_path


@dataclass(frozen=True)
class Node:
    """``weights`` are the weighted rows by class; an inner node sends values up to ``threshold``
    of its ``feature`` (a place in the feature list) to ``left``."""

    id: int
    weights: tuple[float, ...]
    left: int
    right: int
    feature: int
    threshold: float


def export_nodes(model: Model | ForestModel, spark: SparkSession) -> DataFrame:
    """(tree, id, rows, impurity, weights, gain, left, right, feature, threshold) of all nodes,
    from a forest's columns or from the model as Spark saves it."""
    if isinstance(model, ForestModel):
        return model.nodes(spark)
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    data = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in data.columns else data.withColumn("tree", F.lit(0))
    return data.select(
        "tree", "id", F.col("rawCount").alias("rows"), "impurity", F.col("impurityStats").alias("weights"), "gain",
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )


def one_tree(nodes: DataFrame) -> dict[int, Node]:
    """The nodes of a single tree by id; their number is bounded by the tree's depth."""
    rows = nodes.select("id", "weights", "left", "right", "feature", "threshold").collect()
    return {
        r["id"]: Node(r["id"], tuple(r["weights"]), r["left"], r["right"], r["feature"], r["threshold"] if r["left"] >= 0 else 0.0)
        for r in rows
    }


def _walk(nodes: dict[int, Node], features: Sequence[Column], leaf: Callable, inner: Callable, at: int = 0) -> Column:
    node = nodes[at]
    if node.left < 0:
        return leaf(node)
    low = features[node.feature] <= F.lit(node.threshold)
    left, right = (_walk(nodes, features, leaf, inner, k) for k in (node.left, node.right))
    return inner(node, F.when(low, left).otherwise(right))


def tree_probability(nodes: dict[int, Node], features: Sequence[Column]) -> Column:
    """Positive share of the leaf that a row reaches, as nested conditions."""
    share = lambda n: F.lit(n.weights[1] / sum(n.weights))
    return _walk(nodes, features, share, lambda _, below: below)


def tree_forest(nodes: dict[int, Node], features: int) -> ForestModel:
    """The tree as a forest of one, to score in batches."""
    order = [0]
    for i in order:
        if nodes[i].left >= 0:
            order += [nodes[i].left, nodes[i].right]
    place, inner = {k: i for i, k in enumerate(order)}, np.array([nodes[k].left >= 0 for k in order])
    of = lambda value: np.array([value(nodes[k]) for k in order])
    left = of(lambda n: place.get(n.left, -1))
    return ForestModel(features, {
        "tree": np.zeros(len(order), np.int64), "id": np.arange(len(order)), "left": left, "right": np.where(inner, left + 1, -1),
        "feature": of(lambda n: n.feature), "threshold": of(lambda n: n.threshold), "w0": of(lambda n: n.weights[0]), "w1": of(lambda n: n.weights[1]),
    })


def tree_path(nodes: dict[int, Node], features: Sequence[Column]) -> Column:
    """Ids of the nodes that a row passes, from the root to its leaf."""
    return _walk(
        nodes, features, lambda n: F.array(F.lit(n.id)), lambda n, below: F.concat(F.array(F.lit(n.id)), below)
    )


def _gini(a: Column, b: Column) -> Column:
    total = a + b
    return F.lit(1.0) - (a * a + b * b) / (total * total)


def replay_splits(rows: DataFrame, nodes: DataFrame, features: Sequence[Column]) -> DataFrame:
    """(id, rows, rows_again, impurity, impurity_again, gain, gain_again, weights_gap) of every node
    of one tree: what the model holds, and the same from the rows that reach the node.

    ``rows`` are the training rows with label and weight. One aggregation over (node, label): a
    row counts at each node of its path, and the sums of tasks have one row a node.
    """
    path = tree_path(one_tree(nodes), features)
    again = rows.select("label", "weight", F.explode(path).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("rows_again"),
        F.sum(F.when(F.col("label") == 0, F.col("weight")).otherwise(0.0)).alias("w0"),
        F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0.0)).alias("w1"),
    ).withColumn("impurity_again", _gini(F.col("w0"), F.col("w1")))
    kept = nodes.select("id", "rows", "impurity", "weights", "gain", "left", "right").join(F.broadcast(again), "id", "left")

    def child(side: str) -> DataFrame:
        return F.broadcast(again.select(
            F.col("id").alias(side), (F.col("w0") + F.col("w1")).alias(f"w_{side}"), F.col("impurity_again").alias(f"i_{side}")
        ))

    full = kept.join(child("left"), "left", "left").join(child("right"), "right", "left")
    total = F.col("w0") + F.col("w1")
    gain = F.col("impurity_again") - (
        F.col("w_left") / total * F.col("i_left") + F.col("w_right") / total * F.col("i_right")
    )
    gap = F.greatest(F.abs(F.col("w0") - F.col("weights")[0]), F.abs(F.col("w1") - F.col("weights")[1]))
    return full.select(
        "id", "rows", "rows_again", "impurity", "impurity_again", "gain",
        F.when(F.col("left") >= 0, gain).otherwise(-1.0).alias("gain_again"), gap.alias("weights_gap"),
    )


def importance_of(nodes: DataFrame) -> DataFrame:
    """(feature, importance) by place in the feature list: gains weighted by the rows of their nodes,
    shares within each tree, averaged over trees and scaled to one."""
    weight = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    split = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("gain"))
    per_tree = split.groupBy("tree").agg(F.sum("gain").alias("all"))
    shares = split.join(per_tree, "tree").where("all > 0").groupBy("feature").agg(F.sum(F.col("gain") / F.col("all")).alias("s"))
    return shares.select("feature", (F.col("s") / shares.agg(F.sum("s")).scalar()).alias("importance"))
