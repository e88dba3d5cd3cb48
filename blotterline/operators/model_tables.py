"""Fitted models as tables, and what can be checked on them with plain aggregates.

A tree model becomes a table of nodes, small as the model itself, which the driver holds anyway. Rows
are scored from that table by built-in functions, level by level; importances are computed again
from the nodes' statistics or from the training rows; a logistic regression is checked by the
gradient of its loss, which is zero at the optimum.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.operators.importance import slot_names
from blotterline.schema import ENCODED, FEATURE_INPUTS
from blotterline.session import work_folder

#: How a kind of model makes a prediction of its trees.
VOTES, MARGIN = "votes", "margin"


def kind_of(model: PipelineModel) -> str:
    """``margin`` for boosted trees, whose trees are regressions, else ``votes``."""
    return MARGIN if type(model.stages[-1]).__name__.startswith("GBT") else VOTES


def node_table(model: PipelineModel) -> DataFrame:
    """The nodes of a pipeline's tree model, read from its stored form.

    tree, weight (of the tree), node (0 is the root), feature (slot of the vector, -1 at leaves),
    threshold (values up to it go left; null for categories), categories (values that go left),
    left, right (-1 at leaves), prediction, gain, impurity, stats (of the rows that a node was made
    from: rows per class, or count, sum and sum of squares).
    """
    spark = SparkSession.active()
    path = work_folder(spark, "tree-model")
    model.stages[-1].write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata")
        weights = weights.select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*").join(weights, "tree")
    else:
        data = data.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), "*")
    split = F.col("split.leftCategoriesOrThreshold")
    is_number = F.col("split.numCategories") < 0
    return data.select(
        "tree",
        "weight",
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.when(is_number & (F.size(split) > 0), split[0]).alias("threshold"),
        F.when(~is_number, split).alias("categories"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        "prediction",
        "gain",
        "impurity",
        F.col("impurityStats").alias("stats"),
    )


def _forest(nodes: DataFrame) -> Column:
    """All trees as one value: an array of trees, each an array of its nodes by number.

    A scalar subquery, as large as the model.
    """
    names = ["node", *[name for name in nodes.columns if name not in ("tree", "node")]]
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("nodes"))
    whole = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees"))
    return whole.select(F.transform("trees", lambda t: t["nodes"])).scalar()


def _leaf(tree: Column, x: Column, depth: int) -> Column:
    """The node that a row's values lead to, a level at a time."""

    def down(at: Column, _: Column) -> Column:
        node = tree[at]
        value = x[node["feature"]]
        goes_left = F.when(node["threshold"].isNotNull(), value <= node["threshold"]).otherwise(
            F.array_contains(node["categories"], value)
        )
        return F.when(node["left"] < 0, at).otherwise(F.when(goes_left, node["left"]).otherwise(node["right"]))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down)


def depth_of(nodes: DataFrame) -> int:
    """Levels below the root of the deepest tree."""
    level = nodes.where("node = 0").select("tree", "node")
    links = nodes.where("left >= 0").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    depth = 0
    while True:
        level = level.join(links, ["tree", "node"]).select("tree", F.col("child").alias("node"))
        if level.isEmpty():
            return depth
        depth += 1


def with_leaves(rows: DataFrame, nodes: DataFrame, features: str = "features") -> DataFrame:
    """``rows`` with ``leaves``: of each tree, the node that the row ends in. No shuffle."""
    depth = max(1, depth_of(nodes))
    made = rows.withColumn("__x", vector_to_array(F.col(features))).withColumn("__forest", _forest(nodes))
    ends = F.transform("__forest", lambda tree: tree[_leaf(tree, F.col("__x"), depth)])
    return made.withColumn("leaves", ends).drop("__x", "__forest")


def predict_from_nodes(rows: DataFrame, nodes: DataFrame, kind: str, features: str = "features") -> DataFrame:
    """``rows`` with ``table_prediction``: what the trees of ``nodes`` make of them.

    ``votes`` adds up the class shares of the leaves and takes the first of the greatest;
    ``margin`` adds up the weighted values of the leaves and asks whether they exceed zero.
    """
    made = with_leaves(rows, nodes, features)
    if kind == MARGIN:
        margin = F.aggregate("leaves", F.lit(0.0), lambda s, leaf: s + leaf["weight"] * leaf["prediction"])
        prediction = F.when(margin > 0, 1.0).otherwise(0.0)
    else:

        def shares(leaf: Column) -> Column:
            total = F.aggregate(leaf["stats"], F.lit(0.0), lambda s, n: s + n)
            return F.transform(leaf["stats"], lambda n: n / total)

        nothing = F.transform(F.col("leaves")[0]["stats"], lambda n: n * 0.0)
        votes = F.aggregate("leaves", nothing, lambda s, leaf: F.zip_with(s, shares(leaf), lambda a, b: a + b))
        prediction = F.array_position(votes, F.array_max(votes)).cast("double") - 1
    return made.withColumn("table_prediction", prediction).drop("leaves")


def _impurity(stats: Column, kind: str) -> Column:
    """Gini impurity of class counts, or the variance of count, sum and sum of squares."""
    if kind == MARGIN:
        return (stats[2] - stats[1] * stats[1] / stats[0]) / stats[0]
    total = _count(stats, kind)
    return 1 - F.aggregate(stats, F.lit(0.0), lambda s, n: s + (n / total) * (n / total))


def _count(stats: Column, kind: str) -> Column:
    return stats[0] if kind == MARGIN else F.aggregate(stats, F.lit(0.0), lambda s, n: s + n)


def gains(nodes: DataFrame, kind: str) -> DataFrame:
    """tree, node, feature, count, gain of every inner node, from its and its children's ``stats``."""

    def child(side: str) -> DataFrame:
        return nodes.select("tree", F.col("node").alias(side), F.col("stats").alias(f"{side}_stats"))

    inner = nodes.where("left >= 0").join(child("left"), ["tree", "left"]).join(child("right"), ["tree", "right"])
    count = _count(F.col("stats"), kind)
    below = [
        _count(F.col(f"{side}_stats"), kind) / count * _impurity(F.col(f"{side}_stats"), kind)
        for side in ("left", "right")
    ]
    gain = _impurity(F.col("stats"), kind) - below[0] - below[1]
    return inner.select("tree", "node", "feature", count.alias("count"), gain.alias("gain"))


def importances_from_nodes(nodes: DataFrame, kind: str) -> DataFrame:
    """feature (slot), importance of every slot that a tree splits on, from gains computed again.

    A split counts with its gain times its rows. Votes weigh each tree alike, boosted trees count as
    they are; the sum of all importances is one.
    """
    found = gains(nodes, kind).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("count")).alias("own"))
    if kind == VOTES:
        per_tree = found.groupBy("tree").agg(F.sum("own").alias("total"))
        found = found.join(per_tree, "tree").select("feature", (F.col("own") / F.col("total")).alias("own"))
    summed = found.groupBy("feature").agg(F.sum("own").alias("own"))
    return summed.select("feature", (F.col("own") / summed.agg(F.sum("own")).scalar()).alias("importance"))


def boosted_stats(train: DataFrame, nodes: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """``nodes`` of boosted trees with ``stats`` computed again from the training rows.

    Every row is routed through every tree. A tree is fitted to the negative gradient of the log loss
    at what the trees before it say, the first one to the label as -1 or 1: its leaves' counts,
    sums and sums of squares are one aggregate over rows and trees, and inner nodes add up
    those of the leaves below them.
    """
    y = 2.0 * F.col(label) - 1.0
    routed = with_leaves(train.select(features, label), nodes, features)
    parts = F.transform("leaves", lambda leaf: leaf["weight"] * leaf["prediction"])
    made = routed.select(y.alias("y"), parts.alias("parts"), F.transform("leaves", lambda leaf: leaf["node"]).alias("ends"))

    def entry(leaf: Column, tree: Column) -> Column:
        before = F.aggregate(F.slice("parts", 1, tree), F.lit(0.0), lambda s, x: s + x)
        rest = F.when(tree == 0, F.col("y")).otherwise(4.0 * F.col("y") / (1.0 + F.exp(2.0 * F.col("y") * before)))
        return F.struct(tree.alias("tree"), leaf.alias("node"), rest.alias("rest"))

    leaves = (
        made.select(F.inline(F.transform("ends", entry)))
        .groupBy("tree", "node")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum("rest").alias("s"),
            F.sum(F.col("rest") * F.col("rest")).alias("q"),
        )
    )
    # Every node's sums over the leaves below it: climb from the leaves to the roots.
    links = nodes.where("left >= 0").select(
        "tree", F.col("node").alias("parent"), F.explode(F.array("left", "right")).alias("node")
    )
    level, total = leaves, leaves
    for _ in range(depth_of(nodes)):
        level = level.join(links, ["tree", "node"]).select("tree", F.col("parent").alias("node"), "n", "s", "q")
        total = total.unionByName(level)
    sums = total.groupBy("tree", "node").agg(F.array(F.sum("n"), F.sum("s"), F.sum("q")).alias("stats"))
    return nodes.drop("stats").join(sums, ["tree", "node"])


def logistic_gradient(model: PipelineModel, train: DataFrame) -> DataFrame:
    """slot, gradient: the mean log loss of the training rows, differentiated by each coefficient.

    Zero in every slot where a fit without penalty has found its optimum. Each slot is measured in
    standard deviations of its values, as the fit does; ``intercept`` comes first in the vector's
    order. One aggregate: a row counts for its numbers and its two categories, all other slots
    of the one-hot vectors being zero for it.
    """
    slots = slot_names(model)
    predicted = model.transform(train)
    rest = vector_to_array("probability")[1] - F.col("label")
    numbers = [name for name in FEATURE_INPUTS if name not in ENCODED]

    def entry(slot: Column, value: Column) -> Column:
        return F.struct(slot.alias("slot"), value.cast("double").alias("x"))

    entries = [entry(F.lit("intercept"), F.lit(1.0)), *[entry(F.lit(n), F.col(n)) for n in numbers]]
    for encoded, (_, source) in ENCODED.items():
        entries.append(entry(F.concat(F.lit(f"{encoded}_"), F.col(source)), F.lit(1.0)))
    rows = predicted.select(rest.alias("rest"), F.inline(F.array(*entries)))
    sums = rows.where(F.col("slot").isNotNull()).groupBy("slot").agg(
        F.sum(F.col("rest") * F.col("x")).alias("g"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q")
    )
    n = F.lit(train.count())
    spread = F.sqrt(F.greatest((F.col("q") - F.col("s") * F.col("s") / n) / (n - 1), F.lit(0.0)))
    scale = F.when(spread > 0, spread).otherwise(1.0)
    wanted = model.stages[-1].numFeatures
    if wanted != len(slots):
        raise ValueError("the model's slots are not those of its preparation")
    return sums.select("slot", (F.col("g") / n / scale).alias("gradient"))
