"""Two small models as their node tables, fitted once by questmart.learning.study and kept to score given tables with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.learning import trees

# Fixed values: (tree, node, input or input=category, threshold, below, above, prediction, weight of the tree).
PASSED = [
    (0, 0, "base_weapon=mace", 0.5, 6, 1, 0.0, 1.0),
    (0, 1, "rarity_weapon", 0.5, 2, 5, 0.0, 1.0),
    (0, 2, "success_score_floor", 3775.0, 3, 4, 0.0, 1.0),
    (0, 3, None, None, -1, -1, 0.0, 1.0),
    (0, 4, None, None, -1, -1, 1.0, 1.0),
    (0, 5, None, None, -1, -1, 0.0, 1.0),
    (0, 6, "skin=e_mage", 0.5, 10, 7, 0.0, 1.0),
    (0, 7, "success_score_floor", 4625.0, 8, 9, 0.0, 1.0),
    (0, 8, None, None, -1, -1, 0.0, 1.0),
    (0, 9, None, None, -1, -1, 1.0, 1.0),
    (0, 10, None, None, -1, -1, 0.0, 1.0),
]
SCORE = [
    (0, 0, "success_score_floor", 5625.0, 1, 4, 3664.2969, 1.0),
    (0, 1, "success_score_floor", 2575.0, 2, 3, 3638.816, 1.0),
    (0, 2, None, None, -1, -1, 3779.5257, 1.0),
    (0, 3, None, None, -1, -1, 3561.2571, 1.0),
    (0, 4, "base_armor=cloak", 0.5, 5, 6, 4619.1579, 1.0),
    (0, 5, None, None, -1, -1, 4068.7, 1.0),
    (0, 6, None, None, -1, -1, 5230.7778, 1.0),
    (1, 0, "success_score_floor", 1325.0, 1, 4, 0.0, 0.3),
    (1, 1, "skin=r_assassin", 0.5, 2, 3, -647.0514, 0.3),
    (1, 2, None, None, -1, -1, -860.2928, 0.3),
    (1, 3, None, None, -1, -1, 477.3123, 0.3),
    (1, 4, "skin=e_mage", 0.5, 5, 6, 67.4419, 0.3),
    (1, 5, None, None, -1, -1, -28.2909, 0.3),
    (1, 6, None, None, -1, -1, 327.7491, 0.3),
    (2, 0, "base_weapon=dagger", 0.5, 4, 1, 0.0, 0.3),
    (2, 1, "success_score_floor", 3175.0, 2, 3, -217.6955, 0.3),
    (2, 2, None, None, -1, -1, 333.8511, 0.3),
    (2, 3, None, None, -1, -1, -656.2202, 0.3),
    (2, 4, "success_score_floor", 5275.0, 5, 6, 93.1158, 0.3),
    (2, 5, None, None, -1, -1, 32.3135, 0.3),
    (2, 6, None, None, -1, -1, 654.9297, 0.3),
]
MODELS = {"passed": (trees.SINGLE, PASSED, 3), "score": (trees.SUM, SCORE, 2)}


def inputs(name: str) -> list[str]:
    return sorted({row[2] for row in MODELS[name][1] if row[2]})


def features(name: str) -> Column:
    """The model's inputs of a row, in the order of ``inputs``; a category as 0 or 1."""
    parts = [given.partition("=") for given in inputs(name)]
    return F.array(*[(F.col(column) == category if category else F.col(column)).cast("double") for column, _, category in parts])


def table(spark: SparkSession, name: str) -> trees.NodeTable:
    kind, rows, depth = MODELS[name]
    order = {given: place for place, given in enumerate(inputs(name))}
    nodes = [(0, tree, node, order.get(given), cut, below, above, value, None, weight) for tree, node, given, cut, below, above, value, weight in rows]
    schema = "label INT, tree INT, node INT, feature INT, threshold DOUBLE, below INT, above INT, prediction DOUBLE, votes ARRAY<DOUBLE>, weight DOUBLE"
    return trees.NodeTable(kind, spark.createDataFrame(nodes, schema), depth)


def predictions(rows: DataFrame, name: str) -> DataFrame:
    return trees.with_prediction(rows.withColumn("_f", features(name)), table(rows.sparkSession, name), "_f").drop("_f")


def prediction_ctes(name: str, rows: str) -> str:
    """CTEs ``featured`` (rows with their features as a list and as text) and ``scored`` (row_id: that text, prediction)."""
    kind, nodes, _ = MODELS[name]
    order = {given: place for place, given in enumerate(inputs(name))}

    def shown(value: object) -> str:
        return "NULL" if value is None else str(value)

    values = ", ".join(
        f"(0, {tree}, {node}, {shown(order.get(given))}, {shown(cut)}, {below}, {above}, {value}, {weight})"
        for tree, node, given, cut, below, above, value, weight in nodes
    )
    own = f"""(SELECT label, tree, node, feature, CAST(threshold AS DOUBLE) AS threshold, below, above, CAST(prediction AS DOUBLE) AS prediction,
    CAST(NULL AS DOUBLE[]) AS votes, CAST(weight AS DOUBLE) AS weight FROM (VALUES {values}) AS v(label, tree, node, feature, threshold, below, above, prediction, weight))"""
    parts = [given.partition("=") for given in inputs(name)]
    listed = ", ".join(f"CAST({column} = '{category}' AS DOUBLE)" if category else f"CAST({column} AS DOUBLE)" for column, _, category in parts)
    distinct = "(SELECT DISTINCT row_id, features FROM featured)"
    return f"""featured AS (SELECT *, CAST(features AS VARCHAR) AS row_id FROM (SELECT *, [{listed}] AS features FROM {rows})),
scored AS ({trees.scoring_sql(kind, distinct, own)})"""
