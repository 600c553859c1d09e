"""Trained models as tables, and what can be proved from them with plain aggregates and joins.

A logistic model is right if the gradient of its objective vanishes on the rows it was fitted on. A forest is a table of
nodes: rows walk it by joins, two levels a join, and its importances are sums over its splits. Neither needs the
library that fitted the model, so scores and weights can be recomputed wherever the tables can be read.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskflow.models.scorers import MlScorer
from riskflow.models.training import weighted
from riskflow.session import scratch_path, stored

#: Nodes of a forest that is sent to all executors (some 100 bytes each); a larger one is joined by a shuffle.
SENT_NODES = 500_000


def logistic_gradient(scorer: MlScorer, train: DataFrame, label: str = "label") -> DataFrame:
    """``position`` (-1 for the intercept), ``coefficient`` and ``gradient``: the mean slope of the penalised, weighted loss.

    A coefficient whose feature is zero in all rows has the penalty's slope only. One row per feature.
    """
    spark, fitted = train.sparkSession, scorer.classifier
    data, n = weighted(train.select(F.col(label).alias("label"), "features"))
    residual = F.col("weight") * (F.col("probability") - F.col("label"))
    cells = scorer.score(data).select(residual.alias("residual"), F.posexplode(F.concat(F.array(F.lit(1.0)), vector_to_array("features"))).alias("place", "x"))
    slopes = cells.where("x <> 0").groupBy((F.col("place") - 1).alias("position")).agg((F.sum(F.col("residual") * F.col("x")) / F.lit(max(n, 1))).alias("slope"))
    beta = [float(b) for b in fitted.coefficients.toArray()]
    terms = [(-1, float(fitted.intercept), 0.0), *((i, b, fitted.getRegParam() * b) for i, b in enumerate(beta))]
    return spark.createDataFrame(terms, "position int, coefficient double, pull double").join(slopes, "position", "left").select(
        "position", "coefficient", (F.coalesce("slope", F.lit(0.0)) + F.col("pull")).alias("gradient"))


def forest_nodes(scorer: MlScorer) -> DataFrame:
    """A forest's nodes: ``tree``, ``node`` (0 is the root), children (-1: a leaf), ``feature``, ``bounds``, ``categories``, ``gain``, ``weight``, ``share``.

    Values up to ``bounds[0]`` go left; of a feature with categories (``categories`` >= 0) those in ``bounds`` do.
    ``weight`` is the weighted number of rows at the node, ``share`` the part of them in class 1.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    scorer.classifier.write().save(path)
    n, total = F.col("nodeData"), F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda a, b: a + b)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), n["split"]["leftCategoriesOrThreshold"].alias("bounds"), n["split"]["numCategories"].alias("categories"),
        n["gain"].alias("gain"), total.alias("weight"), (F.get(n["impurityStats"], F.lit(1)) / total).alias("share"))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by their key, so that all cores have a share of what follows, however few files there are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def walk(scorer: MlScorer, nodes: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """``key`` (unique) and ``probability`` of every row, found by joins with the node table only.

    A row becomes one state for each tree, which moves down two levels a join, as a node's row has its children's splits
    beside its own; all joins share one stage where the table is small enough to send. Rows are dealt by key before they
    become states, so that the scores need no other shuffle. A step reads plain columns, and a leaf leads to itself: lists
    and further cases in each step make a stage of many joins longer than the JVM compiles.
    """
    forest = scorer.classifier
    sent = F.broadcast if forest.totalNumNodes <= SENT_NODES else lambda t: t
    leaf = F.col("left") < 0
    fields = {"left": F.when(leaf, F.col("node")).otherwise(F.col("left")), "right": F.when(leaf, F.col("node")).otherwise(F.col("right")),
              "feature": F.when(leaf, F.lit(0)).otherwise(F.col("feature")), "bound": F.coalesce(F.get("bounds", F.lit(0)), F.lit(0.0))}
    if categories := not nodes.where((F.col("categories") >= 0) & ~leaf).isEmpty():
        fields["chosen"] = F.when(F.col("categories") >= 0, F.col("bounds"))

    def down(at: str, left: Column, right: Column) -> Column:
        x = F.get("x", F.col(f"{at}feature"))
        leftward = x <= F.col(f"{at}bound")
        if categories:
            leftward = F.when(F.col(f"{at}chosen").isNull(), leftward).otherwise(F.array_contains(f"{at}chosen", x))
        return F.when(leftward, left).otherwise(right)

    steps = nodes.select("tree", "node", *(f.alias(c) for c, f in fields.items()))
    for child in ("left", "right"):
        below = nodes.select("tree", F.col("node").alias(child), *(f.alias(f"{child}_{c}") for c, f in fields.items()))
        steps = steps.join(below, ["tree", child])
    steps = stored(steps.drop("left", "right"), "forest_steps")  # all joins read it
    rows = dealt(df.select(F.col(key).alias("key"), vector_to_array("features").alias("x")), "key")
    state = rows.select("key", "x", F.explode(F.sequence(F.lit(0), F.lit(forest.getNumTrees - 1))).alias("tree"), F.lit(0).alias("node"))
    below = down("", *(down(f"{c}_", F.col(f"{c}_left"), F.col(f"{c}_right")) for c in ("left", "right")))
    for _ in range(-(-max(t.depth for t in forest.trees) // 2)):
        state = state.join(sent(steps), ["tree", "node"]).select("key", "x", "tree", below.alias("node"))
    leaves = state.join(sent(nodes.select("tree", "node", "share")), ["tree", "node"])
    return leaves.groupBy("key").agg(F.avg("share").alias("probability")).withColumnRenamed("key", key)


def forest_importances(nodes: DataFrame) -> DataFrame:
    """``feature`` and ``importance``: weighted gains, each tree's and then the whole summing to one; features never split on are left out."""
    splits = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    trees = splits.groupBy("tree").agg(F.sum("g").alias("of_tree"))
    shares = splits.join(trees, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("of_tree")).alias("s"))
    # One row per feature: a window over all of them is small work for one task.
    return shares.select("feature", (F.col("s") / F.sum("s").over(Window.partitionBy())).alias("importance"))
