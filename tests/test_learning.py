"""Feature table and small studies."""

import random

import pytest
from pyspark.sql import functions as F

from questmart.learning import features, study

SMALL = study.Sizes(tree_depth=3, forest_trees=3, forest_depth=3, boost_rounds=2, boost_depth=2)


@pytest.fixture(scope="module")
def attempts(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        level, strong = rng.randrange(1, 40), rng.random() < 0.5
        score = 800 + level * 50 + (400 if strong else 0) + rng.randrange(50)
        weapon = "l_wp_staff" if strong else "c_wp_mace"
        rows.append((f"LEVEL_{level:03d}", weapon, "u_arm_cloak", rng.choice([None, "r_hi_tower_shield"]), "s_r_mage", strong, str(score), str(3 if strong else 0)))
    rows += [("TUTORIAL_001", "c_wp_mace", None, None, None, True, "900", "1"), ("LEVEL_001", "c_wp_mace", None, None, None, True, "oops", "1")]
    names = "level_id STRING, equipped_weapon STRING, equipped_armor STRING, equipped_held_item STRING, equipped_skin STRING, is_attempt_successful BOOLEAN, total_score STRING, stars_gained STRING"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def folded(attempts):
    return study.with_folds(features.with_residual(features.model_table(attempts)))


def test_item_parts(spark):
    df = spark.createDataFrame([("c_wp_mace",), ("l_hi_tower_shield",), ("x_wp_bow",), ("c_wp",), ("",), (None,)], "i STRING")
    got = [(r.r, r.b, r.s) for r in df.select(features.rarity(F.col("i")).alias("r"), features.base_item(F.col("i")).alias("b"), features.base_skin(F.coalesce("i", F.lit("missing"))).alias("s")).collect()]
    assert got == [
        (1, "mace", "wp_mace"), (5, "tower_shield", "hi_tower_shield"), (0, "bow", "wp_bow"), (1, "unknown", "missing"), (0, "unknown", "missing"), (0, "unknown", "missing"),
    ]


def test_model_table_rows_and_floor(attempts):
    table = features.model_table(attempts)
    assert table.count() == 240
    assert table.where("success_score_floor % 50 != 0 OR success_score_floor < 800").count() == 0
    assert {r.target_ordinal for r in table.select("target_ordinal").distinct().collect()} == {0, 3}


def test_residual_is_centred(folded):
    row = folded.agg(F.avg("target_residual").alias("m"), F.corr("target_residual", "success_score_floor").alias("c")).first()
    assert abs(row.m) < 1e-6 and abs(row.c) < 1e-6


def test_sample_is_repeatable(attempts):
    a = sorted(map(str, features.hashed_sample(attempts.repartition(3), 50).collect()))
    b = sorted(map(str, features.hashed_sample(attempts.repartition(5), 50).collect()))
    assert a == b and len(a) == 50


@pytest.mark.parametrize("family", study.FAMILIES)
def test_families_learn_the_weapon(folded, family):
    run = study.cross_validate(folded, family, study.TARGETS["binary"], SMALL)
    assert run.mean > 0.95 and run.n_samples == 240 and len(run.scores) == study.FOLDS
    assert run.ranked[0][0] in ("rarity_weapon", "base_weapon_mace", "base_weapon_staff")
    assert sum(run.importances.values()) == pytest.approx(1.0, abs=1e-6)
    text = study.summary_text(run)
    assert "over 5 folds" in text and text.count("%") == 3
    assert study.summary_row(run)["top1"] == run.ranked[0][0]


@pytest.mark.parametrize("target", ["ordinal", "regression", "residual"])
def test_other_targets(folded, target):
    run = study.cross_validate(folded, "Decision Tree", study.TARGETS[target], SMALL)
    assert run.mean > 0.5
    assert ("success_score_floor" in run.importances) == (target != "residual")


def test_multiclass_boosting(folded):
    run = study.cross_validate(folded, "Boosted Trees", study.TARGETS["ordinal"], SMALL)
    assert run.mean > 0.9


def test_tables_and_attribution(spark, folded):
    run = study.cross_validate(folded, "Decision Tree", study.TARGETS["regression"], SMALL)
    assert study.metrics_table(spark, [run]).first().metric == "r2"
    listed = {r.feature: r.importance for r in study.importance_table(spark, [run]).collect()}
    assert {f: v for f, v in listed.items() if v} == {f: v for f, v in run.importances.items() if v}
    # 4 numbers, the categories of each column and a place for unseen values.
    assert len(listed) == 4 + sum(folded.select(c).distinct().count() + 1 for c in features.CATEGORIES)


def test_categories_are_numbered_by_column_and_joined(spark):
    def row(weapon, armor):
        return (800, 1, 2, 3, weapon, armor, "x", None)

    kinds = ", ".join([*[f"{c} INT" for c in features.NUMERIC], *[f"{c} STRING" for c in features.CATEGORIES]])
    rows = spark.createDataFrame([row(f"w{i % 30:02d}", "b" if i % 2 else "a") for i in range(300)], kinds).repartition(7)
    encoding = study.Encoding.fit(rows, features.NUMERIC)
    assert encoding.sizes == {"base_weapon": 30, "base_armor": 2, "base_held_item": 1, "skin": 0}
    names = {r.place: r.feature for r in encoding.names().collect()}
    assert sorted(names) == list(range(4 + 31 + 3 + 2 + 1))
    new = spark.createDataFrame([row("w07", "b"), row("w99", None)], kinds)
    found = sorted(tuple(names[int(i)] for i in r.features.indices[4:]) for r in encoding.transform(new).collect())
    assert found == [
        ("base_weapon_unseen", "base_armor_unseen", "base_held_item_x", "skin_unseen"),
        ("base_weapon_w07", "base_armor_b", "base_held_item_x", "skin_unseen"),
    ]
    assert study.Encoding.fit(rows.limit(0), features.NUMERIC).sizes == dict.fromkeys(features.CATEGORIES, 0)


def test_attribution_follows_neither_partitions_nor_batches(spark, folded):
    target = study.TARGETS["regression"]
    fitted = study.fit_outside_fold(folded, "Boosted Trees", target, SMALL)
    test = folded.where("fold = 0")
    found = []
    for parts, batch in ((3, 1), (7, 10_000)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        rows = study.permutation_attribution(fitted, test.repartition(parts)).collect()
        found.append({r.feature: r.mean_abs_change for r in rows})
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1]
    moved = found[0]
    assert set(moved) == set(fitted.inputs)
    assert max(moved, key=moved.get) == "success_score_floor" and moved["skin"] == 0


def test_attribution_against_the_donors_by_hand(spark, folded):
    """One column swapped in plain Python, scored by the model, against the operator's figure."""
    fitted = study.fit_outside_fold(folded, "Decision Tree", study.TARGETS["regression"], SMALL)
    test = folded.where("fold = 0")
    donors = study.with_donors(test, fitted.inputs).collect()
    kinds = ", ".join(f"{n} {t}" for n, t in test.select(*fitted.inputs).dtypes)
    plain = spark.createDataFrame([tuple(r[c] for c in fitted.inputs) for r in donors], kinds)
    swapped = spark.createDataFrame(
        [tuple(r["donor_success_score_floor"] if c == "success_score_floor" else r[c] for c in fitted.inputs) for r in donors], kinds
    )
    was = [r.p for r in fitted.predict(plain.coalesce(1), "p").collect()]
    now = [r.p for r in fitted.predict(swapped.coalesce(1), "p").collect()]
    want = sum(abs(x - y) for x, y in zip(was, now)) / len(was)
    got = {r.feature: r.mean_abs_change for r in study.permutation_attribution(fitted, test).collect()}
    assert got["success_score_floor"] == pytest.approx(want, abs=1e-9) and want > 0


def test_donors_permute_the_whole_table(spark):
    rows = spark.createDataFrame([(i % 40, None if i % 9 == 0 else f"s{i % 5}") for i in range(300)], "a INT, b STRING")
    found = []
    for parts in (1, 3, 7):
        got = [tuple(r) for r in study.with_donors(rows.repartition(parts), ["a", "b"]).collect()]
        assert sorted(map(str, (r[:2] for r in got))) == sorted(map(str, (r[2:] for r in got))) == sorted(str(tuple(r)) for r in rows.collect())
        found.append(sorted(map(str, got)))
    assert found[0] == found[1] == found[2]
    assert sum(r[:2] != r[2:] for r in got) > 250
    assert study.with_donors(rows.limit(0), ["a", "b"]).count() == 0


def test_folds_do_not_follow_the_partitioning(spark):
    table = spark.range(500).selectExpr("id", "id % 7 AS v")
    folds = [{r.id: r.fold for r in study.with_folds(table.repartition(n)).collect()} for n in (2, 5)]
    assert folds[0] == folds[1] and set(folds[0].values()) == set(range(study.FOLDS))


def test_long_item_ids_are_kept_whole(spark):
    item = "_".join(["R", "slot", *[f"p{i}" for i in range(150)]])
    row = spark.createDataFrame([(item,)], "item STRING").select(features.base_item("item").alias("b"), features.base_skin("item").alias("s")).first()
    assert row.b.split("_") == [f"p{i}" for i in range(150)] and len(row.s.split("_")) == 151
