"""Node tables: every model family scored from its table on Spark, by its table in SQL, and by the fitted model itself."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from questmart.learning import study, trees
from tests.test_learning import SMALL, attempts, folded  # noqa: F401  (fixtures)

CASES = [
    ("Decision Tree", "binary", SMALL.tree_depth),
    ("Decision Tree", "ordinal", SMALL.tree_depth),
    ("Decision Tree", "regression", SMALL.tree_depth),
    ("Random Forest", "ordinal", SMALL.forest_depth),
    ("Random Forest", "residual", SMALL.forest_depth),
    ("Boosted Trees", "binary", SMALL.boost_depth),
    ("Boosted Trees", "ordinal", SMALL.boost_depth),
    ("Boosted Trees", "regression", SMALL.boost_depth),
]


@pytest.mark.parametrize("family, goal, depth", CASES)
def test_node_table_scores_like_the_model_and_like_sql(spark, folded, folder, family, goal, depth):  # noqa: F811
    target = study.TARGETS[goal]
    fitted = study.fit_outside_fold(folded, family, target, SMALL)
    table = trees.node_table(spark, fitted.model, depth)
    rows = fitted.encoding.transform(folded).select(
        F.monotonically_increasing_id().alias("row_id"), "features", vector_to_array("features").alias("f"), F.col(target.column).cast("double").alias("y")
    )
    rows = study.stage(rows, "rows")
    own = trees.with_prediction(rows, table, "f", target.classes, "own")
    both = fitted.model.transform(own).select("row_id", "own", "prediction", "y").collect()
    assert len(both) == 240 and all(r.own == pytest.approx(r.prediction, abs=1e-6) for r in both)
    assert len({r.own for r in both}) > 1

    rows.select("row_id", F.col("f").alias("features"), "y").write.parquet(f"{folder}/rows")
    table.nodes.select(*trees.NODE_COLUMNS).write.parquet(f"{folder}/nodes")
    sql = trees.scoring_sql(table.kind, f"(SELECT * FROM '{folder}/rows/*.parquet')", f"(SELECT * FROM '{folder}/nodes/*.parquet')")
    scored = dict(duckdb.sql(sql).fetchall())
    assert scored == pytest.approx({r.row_id: r.own for r in both}, abs=1e-6)
    # The metric of the stored model is the same aggregate in both engines.
    value = "avg(CAST(prediction = y AS DOUBLE))" if target.is_classifier else "1 - sum((y - prediction) ** 2) / (var_pop(y) * count(*))"
    metric = duckdb.sql(f"SELECT {value} FROM ({sql}) JOIN '{folder}/rows/*.parquet' USING (row_id)").fetchall()[0][0]
    assert metric == pytest.approx(study.score(own.withColumn(target.column, F.col("y")).withColumn("prediction", F.col("own")), target), abs=1e-6)


def test_a_plan_without_join_or_udf(spark, folded):  # noqa: F811
    fitted = study.fit_outside_fold(folded, "Random Forest", study.TARGETS["binary"], SMALL)
    table = trees.node_table(spark, fitted.model, SMALL.forest_depth)
    rows = spark.createDataFrame([(1, [0.0] * 40)], "row_id INT, f ARRAY<DOUBLE>")
    text = trees.with_prediction(rows, table, "f", 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and "UDF" not in text and "split(" not in text


def test_stored_node_table_is_enough(spark, folded, folder):  # noqa: F811
    """Nodes written out and read again in place of the fitted object give the same predictions."""
    target = study.TARGETS["regression"]
    fitted = study.fit_outside_fold(folded, "Boosted Trees", target, SMALL)
    table = trees.node_table(spark, fitted.model, SMALL.boost_depth)
    table.nodes.write.parquet(f"{folder}/nodes")
    again = trees.NodeTable(table.kind, spark.read.parquet(f"{folder}/nodes"), table.depth)
    rows = fitted.encoding.transform(folded).select(vector_to_array("features").alias("f"))
    scored = trees.with_prediction(trees.with_prediction(rows, table, "f", name="a"), again, "f", name="b")
    assert scored.where("a <> b OR a IS NULL").count() == 0
