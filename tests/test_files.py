"""Files, bronze load, layered run."""

import datetime as dt
import json
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from questmart.learning import study
from questmart.plans import pipeline
from questmart.sources import files
from questmart.sources.bronze import bootstrap_bronze, load_bronze
from questmart.sources.star_tables import bronze_from_star
from tests.tables import at, event, frame, session


def test_csv_keeps_quotes_commas_and_nulls(spark, folder):
    rows = [
        {"account_id": "a", "username": 'say "hi", you', "acquisition_metadata": '{"ad_name":"x, \\"y\\""}', "signup_date": at("2025-01-01 10:00:00")},
        {"account_id": "b", "email_is_anonymized": True},
    ]
    accounts = frame(spark, "accounts", rows)
    path = files.write_tables({"accounts": accounts}, folder)["accounts"]
    back = files.read_csv_table(spark, path, "accounts")
    assert back.dtypes == accounts.dtypes
    assert sorted(back.collect()) == sorted(accounts.collect())


def test_sample_beside_the_table(spark, folder):
    files.write_tables({"t": spark.range(20).toDF("id")}, folder, "parquet", sample_rows=3)
    assert spark.read.parquet(f"{folder}/t").count() == 20
    assert spark.read.parquet(f"{folder}/t_sample").count() == 3
    with pytest.raises(ValueError):
        files.write_tables({}, folder, "xml")


def test_normalise(spark):
    df = spark.sql("SELECT array(1, 2) AS a, map('k', 1) AS m, named_struct('x', 'y') AS s, double('NaN') AS n, 1.5D AS v")
    assert tuple(files.normalize(df).first()) == ("[1,2]", '{"k":1}', '{"x":"y"}', None, 1.5)


def test_chronological_files_are_in_order(spark, folder):
    df = spark.range(500).select((500 - F.col("id")).alias("t"))
    files.write_chronological(df, f"{folder}/out", ["t"])
    parts = spark.read.parquet(f"{folder}/out").groupBy(F.input_file_name().alias("f")).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    spans = [(r.lo, r.hi) for r in parts.orderBy("f").collect()]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and sum(1 for _ in spans) >= 1


def test_load_replace_and_append(spark, folder):
    rows = [session(1, "a", "2025-01-01 10:00:00", 30), session(2, "a", "2025-01-01 11:00:00", 40)]
    sessions = frame(spark, "sessions", rows).drop("duration_seconds")
    files.write_one(sessions.coalesce(1), f"{folder}/in/sessions.csv", "csv")
    assert files.list_csv_tables(spark, f"{folder}/in/sessions.csv") != {}
    events = frame(spark, "events", [event(None, "ad", "x", f"2025-01-01 10:0{n}:00", "a") for n in (3, 1, 2)]).drop("event_id")
    bootstrap_bronze(spark, frames={"sessions": sessions, "events": events}, database="b1")
    assert sorted(r.duration_seconds for r in spark.table("b1.sessions").collect()) == [30, 40]
    assert [(r.event_date.minute, r.event_id) for r in spark.table("b1.events").orderBy("event_id").collect()] == [(1, 1), (2, 2), (3, 3)]
    load_bronze(spark, {"events": events.limit(1)}, "b1", "append")
    assert sorted(r.event_id for r in spark.table("b1.events").collect()) == [1, 2, 3, 4]
    assert spark.table("b1.exchange_rate").count() == 17
    files.load_frames(spark, "b1", {"hosted_ads": [("x", "n", "p", "CPM", 1.0, None, None, True, 30, False)]})
    files.export_csv(spark, "b1.hosted_ads", f"{folder}/ads")
    assert spark.read.option("header", True).csv(f"{folder}/ads").first().ad_id == "x"
    with pytest.raises(ValueError):
        load_bronze(spark, {"events": events}, "b1", "merge")


def test_layers_report_and_counts(spark, sf_dir, folder):
    star = bronze_from_star(spark, sf_dir)
    names = ["accounts", "events", "sessions", "hosted_ads", "hosted_ad_interactions", "ads", "campaigns", "ad_campaign_map"]
    bootstrap_bronze(spark, frames={name: getattr(star, name) for name in names})
    counts = pipeline.run_pipeline(spark)
    assert list(counts) == [m.name for m in pipeline.MARTS]
    assert counts["accounts_extended"] == spark.table("silver.accounts_extended").count() > 0
    report = pipeline.run_ab_report(spark, folder)
    assert report.count() == 6
    assert spark.read.option("header", True).csv(f"{folder}/ab_test_results").count() == 6
    sizes = study.Sizes(tree_depth=2, forest_trees=2, forest_depth=2, boost_rounds=1, boost_depth=2)
    runs = pipeline.run_studies(spark, folder, families=["Random Forest"], targets={"binary": study.TARGETS["binary"]}, sizes=sizes)
    assert spark.read.option("header", True).csv(f"{folder}/summary/model_metrics").count() == len(runs) == 1
    assert spark.read.option("header", True).csv(f"{folder}/individual/random_forest__binary_classification_summary").first().metric == "accuracy"
    assert "Experiment report" in spark.read.text(f"{folder}/ab_test_results_text").first().value


def test_marts_are_stored_in_their_order(spark):
    """Left by the layered run above: files of a mart cover separate ranges, each in order."""
    for mart in pipeline.MARTS:
        assert set(mart.order) <= set(spark.table(f"{mart.layer}.{mart.name}").columns)
    days = [r.session_day for r in spark.table("silver.session_metrics").coalesce(1).collect()]
    assert days == sorted(days) and len(days) > 1


def test_run_stops_at_the_first_failure(spark):
    with pytest.raises(Exception):
        pipeline.run_layer(spark, "silver", bronze="no_such_database")


def test_written_folders_load_again_with_line_breaks_and_pandas_frames(spark, folder):
    import pandas as pd
    import pytest

    notes = spark.createDataFrame([(1, "two\nlines"), (2, "one")], "id INT, note STRING")
    files.write_tables({"notes": notes}, folder)
    found = files.list_csv_tables(spark, folder)
    assert set(found) == {"notes"}
    assert {r.note for r in files.read_csv_table(spark, found["notes"], "notes").collect()} == {"two\nlines", "one"}
    with pytest.raises(ValueError):
        files.list_csv_tables(spark, _empty(folder))
    ads = pd.DataFrame([("x", "n", "p", "CPM", 1.0, None, None, True, 30, False)], columns=HOSTED)
    assert "hosted_ads" in bootstrap_bronze(spark, frames={"hosted_ads": ads}, database="b_pandas")
    assert spark.table("b_pandas.hosted_ads").count() == 1


HOSTED = ["ad_id", "ad_network", "advertised_product", "pricing_model", "value_per_action", "start_date", "end_date", "is_active", "ad_length", "rewarded"]


def _empty(folder):
    import os

    path = f"{folder}/empty"
    os.makedirs(path)
    return path


NESTED = {"offer": "it's", "sold": True, "none": None, "list": [1, {"x": "é"}], "at": dt.datetime(2025, 1, 2, 3, 4, 5), "id": uuid.UUID(int=5)}


def _nested_events():
    base = {"event_type": "business", "event_subtype": "business", "event_date": dt.datetime(2025, 1, 2, 3, 4, 5), "session_id": 4}
    return [
        {**base, "account_id": uuid.UUID(int=7), "event_metadata": NESTED},
        {**base, "account_id": uuid.UUID(int=8), "event_metadata": "plain", "event_date": "2025-01-02 03:04:06"},
        {**base, "account_id": None, "event_metadata": None, "event_date": None},
        {**base, "account_id": "x", "event_metadata": [], "session_id": None},
    ]


@pytest.mark.parametrize("kind", ["rows", "pandas"])
def test_nested_cells_load_as_json(spark, kind):
    rows = _nested_events()
    given = rows if kind == "rows" else pd.DataFrame(rows)
    back = {r.account_id: r for r in files.as_frame(spark, "events", given).collect()}
    own = back[str(uuid.UUID(int=7))]
    assert json.loads(own.event_metadata) == {**NESTED, "at": "2025-01-02T03:04:05", "id": str(uuid.UUID(int=5))}
    assert own.session_id == 4 and own.event_date == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert back[str(uuid.UUID(int=8))].event_metadata == "plain" and back[str(uuid.UUID(int=8))].event_date.second == 6
    assert back[None].event_metadata is None and back[None].event_date is None
    assert back["x"].event_metadata == "[]" and back["x"].session_id is None
    df = files.as_frame(spark, "events", given)
    parts = df.where(F.col("account_id") == str(uuid.UUID(int=7))).select(
        *[F.get_json_object("event_metadata", f"$.{k}") for k in ("offer", "sold", "none", "list[1].x")]
    )
    assert tuple(parts.first()) == ("it's", "true", None, "é")


def test_frames_with_every_kind_of_cell(spark):
    ads = pd.DataFrame({"ad_id": [1, 2], "value_per_action": [1, float("nan")], "start_date": [pd.Timestamp("2025-01-01"), pd.NaT], "is_active": [True, None], "ad_length": [30.0, None]})
    got = [tuple(r) for r in files.as_frame(spark, "hosted_ads", ads).select("ad_id", "value_per_action", "start_date", "is_active", "ad_length", "rewarded").collect()]
    assert got == [("1", 1.0, dt.date(2025, 1, 1), True, 30, None), ("2", None, None, None, None, None)]
    assert files.as_frame(spark, "hosted_ads", []).count() == 0
    campaigns = [{"campaign_id": 1, "associated_ads": [3, 4], "budget": 5}]
    assert files.as_frame(spark, "campaigns", campaigns).first().associated_ads == "[3, 4]"


def test_csv_in_many_tasks(spark, folder):
    accounts = frame(spark, "accounts", [{"account_id": f"a{i}", "username": f"name {i}"} for i in range(3000)])
    files.write_one(accounts.coalesce(1), f"{folder}/accounts", "csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1_000)
    whole, split = (files.read_csv_table(spark, f"{folder}/accounts", "accounts", multi_line) for multi_line in (True, False))
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(split.collect(), key=str) == sorted(whole.collect(), key=str) and split.count() == 3000


def test_a_failed_replacement_leaves_the_old_table(spark):
    good = spark.range(10).withColumn("day", F.col("id") % 3)
    files.save_table(good, "swapped", "t", partition_by=["day"])
    broken = spark.range(10).withColumn("day", F.when(F.col("id") == 7, F.raise_error(F.lit("task fails")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="task fails"):
        files.save_table(broken, "swapped", "t")
    assert spark.table("swapped.t").count() == 10 and spark.table("swapped.t").where("day = 1").count() == 3
    # A table may be replaced by what is read from itself, with other columns too.
    files.save_table(spark.table("swapped.t").where("id < 4").withColumn("x", F.lit(1)), "swapped", "t")
    assert sorted(tuple(r) for r in spark.table("swapped.t").select("id", "x").collect()) == [(i, 1) for i in range(4)]
    files.save_table(spark.createDataFrame([(9, 5, 2)], "id LONG, x INT, day LONG"), "swapped", "t", "append")
    assert spark.table("swapped.t").count() == 5
    assert [t.name for t in spark.catalog.listTables("swapped") if not t.isTemporary] == ["t"]
