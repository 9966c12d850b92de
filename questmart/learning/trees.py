"""Fitted trees and ensembles as tables of nodes, and scoring by those tables.

A model's nodes are a table of their own, so that it can be stored, compared and scored without the fitted object, on Spark or
on any SQL engine (``scoring_sql``). On Spark every row walks down the trees inside one expression over constant arrays: no UDF,
no join and no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.session import new_stage_path

NODE_COLUMNS = ["label", "tree", "node", "feature", "threshold", "below", "above", "prediction", "votes", "weight"]
# How the trees of a model are put together.
SINGLE, VOTES, MEAN, MARGIN, SUM, CLASSES = "single", "votes", "mean", "margin", "sum", "classes"
KINDS = {
    "DecisionTreeClassificationModel": SINGLE,
    "DecisionTreeRegressionModel": SINGLE,
    "RandomForestClassificationModel": VOTES,
    "RandomForestRegressionModel": MEAN,
    "GBTClassificationModel": MARGIN,
    "GBTRegressionModel": SUM,
    "OneVsRestModel": CLASSES,
}


@dataclass(frozen=True)
class NodeTable:
    """``nodes``: one row per node, columns NODE_COLUMNS. A leaf has ``below`` = -1. ``label`` numbers the models of a
    one-against-the-rest ensemble, else it is 0. ``depth`` is a bound of the steps from a root to a leaf."""

    kind: str
    nodes: DataFrame
    depth: int


def _stored_nodes(spark, path: str, label: int) -> DataFrame:
    stored = spark.read.parquet(f"{path}/data")
    if "nodeData" in stored.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weight").drop("metadata")
        stored = stored.join(weights, "treeID").select(F.col("treeID").alias("tree"), F.col("weight").cast("double").alias("weight"), "nodeData.*")
    else:
        stored = stored.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), "*")
    votes = F.col("impurityStats")
    total = F.aggregate(votes, F.lit(0.0), lambda s, v: s + v)
    is_leaf = F.col("leftChild") < 0
    # A one-hot place is stored as a set of categories that go left; of 0 and 1 that is a threshold between them.
    first, kinds = F.get("split.leftCategoriesOrThreshold", F.lit(0)), F.col("split.numCategories")
    swapped = (kinds == 2) & (first == 1)
    threshold = F.when(kinds < 0, first).when(kinds == 2, F.lit(0.5)).otherwise(F.raise_error(F.lit("a split by more than two categories")).cast("double"))
    return stored.select(
        F.lit(label).alias("label"),
        F.col("tree").cast("int").alias("tree"),
        F.col("id").cast("int").alias("node"),
        F.when(~is_leaf, F.col("split.featureIndex")).cast("int").alias("feature"),
        F.when(~is_leaf, threshold).alias("threshold"),
        F.when(~is_leaf & swapped, F.col("rightChild")).otherwise(F.col("leftChild")).cast("int").alias("below"),
        F.when(~is_leaf & swapped, F.col("leftChild")).otherwise(F.col("rightChild")).cast("int").alias("above"),
        "prediction",
        F.transform(votes, lambda v: F.try_divide(v, total)).alias("votes"),
        "weight",
    )


def node_table(spark, model: Model, depth: int) -> NodeTable:
    """The nodes of a fitted model of at most ``depth`` levels, read from what it stores of itself in the shared folder.

    Splits must be by threshold or on a one-hot place, which is all that the encoding here makes.
    """
    kind = KINDS[type(model).__name__]
    parts = model.models if kind == CLASSES else [model]
    nodes: DataFrame | None = None
    for label, part in enumerate(parts):
        path = new_stage_path(spark, "model")
        part.write().save(path)
        own = _stored_nodes(spark, path, label)
        nodes = own if nodes is None else nodes.unionByName(own)
    return NodeTable(kind, nodes, depth)


def _constant(values: list, kind: str) -> Column:
    """An array of numbers that is folded into one constant when the plan is optimised."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


@dataclass(frozen=True)
class _Forest:
    """The nodes of all trees behind one another as constant arrays; children are places in them."""

    roots: Column
    labels: list[int]
    weights: Column
    feature: Column
    threshold: Column
    below: Column
    above: Column
    prediction: Column
    votes: Column
    depth: int

    def leaves(self, features: Column) -> Column:
        """Per tree the place of the leaf that a row's features lead to."""

        def step(at: Column, _: Column) -> Column:
            below = F.get(self.below, at)
            goes_below = F.get(features, F.get(self.feature, at)) <= F.get(self.threshold, at)
            return F.when(below < 0, at).when(goes_below, below).otherwise(F.get(self.above, at))

        return F.transform(self.roots, lambda root: F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), root, step))


def _forest(table: NodeTable, classes: int) -> _Forest:
    rows = table.nodes.orderBy("label", "tree", "node").collect()
    roots, labels, weights, below, above, votes = [], [], [], [], [], []
    for place, row in enumerate(rows):
        if row["node"] == 0:
            roots.append(place)
            labels.append(row["label"])
            weights.append(float(row["weight"]))
        below.append(-1 if row["below"] < 0 else roots[-1] + row["below"])
        above.append(-1 if row["below"] < 0 else roots[-1] + row["above"])
        votes += [float(v or 0) for v in row["votes"][:classes]] if table.kind == VOTES else []
    return _Forest(
        _constant(roots, "int"),
        labels,
        _constant(weights, "double"),
        _constant([-1 if row["feature"] is None else row["feature"] for row in rows], "int"),
        _constant([0.0 if row["threshold"] is None else float(row["threshold"]) for row in rows], "double"),
        _constant(below, "int"),
        _constant(above, "int"),
        _constant([float(row["prediction"]) for row in rows], "double"),
        _constant(votes or [0.0], "double"),
        max(table.depth, 1),
    )


def _total(leaves: Column, value) -> Column:
    """Sum over the trees, rounded so that the order of adding does not show. ``value``: of a leaf's place and its tree."""
    return F.round(F.aggregate(F.transform(leaves, value), F.lit(0.0), lambda s, v: s + v), 9)


def _best(values: Column) -> Column:
    """Place of the greatest value, the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")


def with_prediction(rows: DataFrame, table: NodeTable, features: str, classes: int = 0, name: str = "prediction") -> DataFrame:
    """Adds the model's prediction for an array column of features. ``classes``: how many a classifier knows.

    The nodes pass through the driver: their number is bounded by the model's settings, whatever the data.
    """
    forest = _forest(table, classes)
    scored = rows.withColumn("_leaves", forest.leaves(F.col(features)))
    leaves = F.col("_leaves")

    def weighed(at: Column, tree: Column) -> Column:
        return F.get(forest.weights, tree) * F.get(forest.prediction, at)

    def weighed_of(label: int):
        own = _constant([float(k == label) for k in forest.labels], "double")
        return lambda at, tree: F.get(own, tree) * weighed(at, tree)

    def vote(k: int):
        return lambda at, _: F.get(forest.votes, at * classes + k)

    if table.kind == SINGLE:
        value = F.get(forest.prediction, F.get(leaves, F.lit(0)))
    elif table.kind == VOTES:
        value = _best(F.array(*[_total(leaves, vote(k)) for k in range(classes)]))
    elif table.kind == MEAN:
        value = _total(leaves, lambda at, _: F.get(forest.prediction, at)) / F.size(leaves)
    elif table.kind == MARGIN:
        value = (_total(leaves, weighed) > 0).cast("double")
    elif table.kind == SUM:
        value = _total(leaves, weighed)
    else:
        value = _best(F.array(*[_total(leaves, weighed_of(label)) for label in range(classes)]))
    return scored.withColumn(name, value).drop("_leaves")


def scoring_sql(kind: str, rows: str = "rows", nodes: str = "nodes") -> str:
    """SQL that scores table ``rows`` (row_id, features: a list) by table ``nodes``: (row_id, prediction).

    ``rows`` and ``nodes`` may be names or subqueries in brackets.
    """
    put_together = {
        SINGLE: "SELECT row_id, max(prediction) AS prediction FROM leaves GROUP BY row_id",
        MEAN: "SELECT row_id, round(sum(prediction), 9) / count(*) AS prediction FROM leaves GROUP BY row_id",
        SUM: "SELECT row_id, round(sum(weight * prediction), 9) AS prediction FROM leaves GROUP BY row_id",
        MARGIN: "SELECT row_id, CAST(round(sum(weight * prediction), 9) > 0 AS DOUBLE) AS prediction FROM leaves GROUP BY row_id",
        VOTES: """SELECT row_id, CAST(arg_min(k, (-votes, k)) - 1 AS DOUBLE) AS prediction FROM (
    SELECT row_id, k, round(sum(votes[k]), 9) AS votes FROM leaves, (SELECT unnest(range(1, len(votes) + 1)) AS k FROM (SELECT votes FROM n LIMIT 1))
    GROUP BY row_id, k) GROUP BY row_id""",
        CLASSES: """SELECT row_id, CAST(arg_min(label, (-margin, label)) AS DOUBLE) AS prediction FROM (
    SELECT row_id, label, round(sum(weight * prediction), 9) AS margin FROM leaves GROUP BY row_id, label) GROUP BY row_id""",
    }[kind]
    return f"""WITH RECURSIVE n AS (SELECT * FROM {nodes}), r AS (SELECT * FROM {rows}),
walk AS (
  SELECT r.row_id, t.label, t.tree, 0 AS node FROM r, (SELECT DISTINCT label, tree FROM n) t
  UNION ALL
  SELECT w.row_id, w.label, w.tree, CASE WHEN r.features[n.feature + 1] <= n.threshold THEN n.below ELSE n.above END
  FROM walk w JOIN n ON n.label = w.label AND n.tree = w.tree AND n.node = w.node JOIN r ON r.row_id = w.row_id WHERE n.below >= 0
),
leaves AS (SELECT w.row_id, n.label, n.tree, n.weight, n.prediction, n.votes FROM walk w JOIN n ON n.label = w.label AND n.tree = w.tree AND n.node = w.node WHERE n.below < 0)
{put_together}"""
