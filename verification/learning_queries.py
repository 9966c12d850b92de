"""Feature table and model studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from questmart.learning import features, study
from questmart.plans import analytics
from questmart.session import stage
from questmart.sources.star_tables import bronze_from_star
from verification import stored_models
from verification.mart_queries import EQUIPMENT, P
from verification.registry import query


def _item(slot: str) -> str:
    column = f"COALESCE(equipped_{slot}, '')"
    ranks = " ".join(f"WHEN '{letter}' THEN {rank}" for letter, rank in features.RARITY_RANK.items())
    return f"""CAST(CASE split_part({column}, '_', 1) {ranks} ELSE 0 END AS BIGINT) AS rarity_{slot},
           CASE WHEN len(string_split({column}, '_')) > 2 THEN array_to_string(string_split({column}, '_')[3:], '_') ELSE 'unknown' END AS base_{slot}"""


TABLE = f"""
{EQUIPMENT},
table_rows AS (
    SELECT 800 + (CAST(split_part(level_id, '_', 2) AS BIGINT) - 1) * 50 AS success_score_floor,
           {', '.join(_item(slot) for slot in features.SLOTS)},
           CASE WHEN len(string_split(equipped_skin, '_')) >= 3 THEN array_to_string(string_split(equipped_skin, '_')[2:], '_') ELSE 'missing' END AS skin,
           CAST(COALESCE(is_attempt_successful, false) AS BIGINT) AS target_binary,
           3 - CAST(stars_gained AS BIGINT) AS target_ordinal, CAST(total_score AS DOUBLE) AS target_score
    FROM equipment WHERE total_score IS NOT NULL AND level_id NOT LIKE 'T%')"""


def _table(spark, sf_dir):
    return features.model_table(analytics.equipment_contribution_eda(bronze_from_star(spark, sf_dir), P))


@query("learning_features", f"WITH {TABLE} SELECT * FROM table_rows", ("events",))
def _features(spark, sf_dir):
    return _table(spark, sf_dir)


@query(
    "learning_residual",
    f"""
WITH {TABLE}, line AS (SELECT regr_slope(target_score, success_score_floor) AS a, regr_intercept(target_score, success_score_floor) AS b FROM table_rows)
SELECT success_score_floor, target_score,
       CAST(round(CAST(target_score - (a * success_score_floor + b) AS DECIMAL(18,6)), 3) AS DOUBLE) AS target_residual FROM table_rows, line""",
    ("events",),
)
def _residual(spark, sf_dir):
    table = features.with_residual(_table(spark, sf_dir))
    residual = F.round(F.col("target_residual").cast("decimal(18,6)"), 3)
    return table.select("success_score_floor", "target_score", residual.alias("target_residual"))


INPUTS = [*features.NUMERIC, *features.CATEGORIES]
COLUMNS = [*INPUTS, "target_binary", "target_ordinal", "target_score"]


def _hash(seed: int, columns: list[str]) -> str:
    """The hash order of features.hashed_sample and study.row_order."""
    whole = {"target_score": "CAST(round(target_score) AS BIGINT)"}
    texts = ", ".join(f"COALESCE(CAST({whole.get(c, c)} AS VARCHAR), '')" for c in columns)
    return f"md5(concat_ws('|', '{seed}', {texts}))"


def _numbered(column: str) -> str:
    return f"(SELECT {column} AS category, row_number() OVER (ORDER BY {column}) - 1 AS index FROM (SELECT DISTINCT {column} FROM table_rows WHERE {column} IS NOT NULL))"


@query(
    "learning_encoded",
    f"""
WITH {TABLE}
SELECT r.*, {', '.join(f'COALESCE(c{i}.index, (SELECT count(DISTINCT {c}) FROM table_rows)) AS {c}_index' for i, c in enumerate(features.CATEGORIES))}
FROM (SELECT {', '.join(INPUTS)}, target_score FROM table_rows) r
{' '.join(f'LEFT JOIN {_numbered(c)} c{i} ON c{i}.category = r.{c}' for i, c in enumerate(features.CATEGORIES))}""",
    ("events",),
)
def _encoded(spark, sf_dir):
    table = _table(spark, sf_dir)
    rows = study.Encoding.fit(table, features.NUMERIC).indexed(table)
    return rows.select(*INPUTS, "target_score", *[F.col(f"{c}_index").cast("bigint").alias(f"{c}_index") for c in features.CATEGORIES])


@query("learning_sample", f"WITH {TABLE} SELECT * FROM table_rows ORDER BY {_hash(42, COLUMNS)}, {', '.join(COLUMNS)} LIMIT 100", ("events",))
def _sample(spark, sf_dir):
    return features.hashed_sample(_table(spark, sf_dir), 100)


@query(
    "learning_donors",
    f"""
WITH {TABLE},
a AS (SELECT {', '.join(INPUTS)}, row_number() OVER (ORDER BY {_hash(42, INPUTS)}, {', '.join(INPUTS)}) AS place FROM table_rows),
b AS (SELECT {', '.join(f'{c} AS donor_{c}' for c in INPUTS)}, row_number() OVER (ORDER BY {_hash(43, INPUTS)}, {', '.join(INPUTS)}) AS place FROM table_rows)
SELECT {', '.join(INPUTS)}, {', '.join(f'donor_{c}' for c in INPUTS)} FROM a JOIN b USING (place)""",
    ("events",),
)
def _donors(spark, sf_dir):
    return study.with_donors(_table(spark, sf_dir), INPUTS)


@query(
    "learning_stored_tree",
    f"""
WITH {TABLE}, {stored_models.prediction_ctes('passed', 'table_rows')}
SELECT success_score_floor, rarity_weapon, base_weapon, skin, target_binary, prediction,
       CAST(round(CAST((SELECT avg(CAST(s.prediction = f.target_binary AS DOUBLE)) FROM featured f JOIN scored s USING (row_id)) AS DECIMAL(18,6)), 4) AS DOUBLE) AS accuracy
FROM featured JOIN scored USING (row_id)""",
    ("events",),
)
def _stored_tree(spark, sf_dir):
    rows = stored_models.predictions(_table(spark, sf_dir), "passed")
    accuracy = study.score(rows, study.TARGETS["binary"])
    return rows.select(
        "success_score_floor", "rarity_weapon", "base_weapon", "skin", "target_binary", "prediction",
        F.round(F.lit(accuracy).cast("decimal(18,6)"), 4).alias("accuracy"),
    )


@query(
    "learning_stored_boosting",
    f"""
WITH {TABLE}, {stored_models.prediction_ctes('score', 'table_rows')}
SELECT success_score_floor, base_weapon, base_armor, skin, target_score, CAST(round(CAST(prediction AS DECIMAL(18,6)), 4) AS DOUBLE) AS prediction,
       CAST(round(CAST((SELECT 1 - sum((f.target_score - s.prediction) * (f.target_score - s.prediction)) / (var_pop(f.target_score) * count(*))
                        FROM featured f JOIN scored s USING (row_id)) AS DECIMAL(18,6)), 4) AS DOUBLE) AS r2
FROM featured JOIN scored USING (row_id)""",
    ("events",),
)
def _stored_boosting(spark, sf_dir):
    rows = stored_models.predictions(_table(spark, sf_dir), "score")
    r2 = study.score(rows, study.TARGETS["regression"])
    return rows.select(
        "success_score_floor", "base_weapon", "base_armor", "skin", "target_score",
        F.round(F.col("prediction").cast("decimal(18,6)"), 4).alias("prediction"),
        F.round(F.lit(r2).cast("decimal(18,6)"), 4).alias("r2"),
    )


def _suite(spark, sf_dir, families, targets, sizes=study.Sizes()):
    table = stage(features.with_residual(_table(spark, sf_dir)), "model-table")
    return study.run_suite(table, families, {name: study.TARGETS[name] for name in targets}, sizes)


@query("learning_tree_metrics")
def _tree_metrics(spark, sf_dir):
    return study.metrics_table(spark, _suite(spark, sf_dir, ["Decision Tree"], list(study.TARGETS)))


@query("learning_forest_importance")
def _forest_importance(spark, sf_dir):
    return study.importance_table(spark, _suite(spark, sf_dir, ["Random Forest"], ["binary"]))


# Whole table and all folds; fewer rounds than study.Sizes() has, as each round is a job of its own.
FEW_ROUNDS = study.Sizes(boost_rounds=5, boost_depth=3)


@query("learning_boosted_metrics")
def _boosted_metrics(spark, sf_dir):
    return study.metrics_table(spark, _suite(spark, sf_dir, ["Boosted Trees"], ["binary", "regression"], FEW_ROUNDS))


@query("learning_attribution")
def _attribution(spark, sf_dir):
    folded = study.with_folds(features.with_residual(_table(spark, sf_dir)))
    fitted = study.fit_outside_fold(folded, "Decision Tree", study.TARGETS["regression"])
    return study.permutation_attribution(fitted, folded.where(F.col("fold") == 0))
