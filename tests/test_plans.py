"""Plans a large cluster can carry: no row-pair joins, no unpartitioned windows, pruned scans, small sides broadcast."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from verification import registry
from questmart.operators import adviews
from questmart.operators.currency import purchases_in_usd
from questmart.params import Params
from questmart.plans import analytics, gold, silver
from questmart.schemas import since
from questmart.sources.bronze import load_bronze
from questmart.sources.star_tables import bronze_from_star

P = Params()
# These call eager steps or train models; their parts are tested elsewhere.
EAGER = re.compile(r"learning_(tree|forest|boosted|attribution)|ab_test_report")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not EAGER.search(n)))
def test_no_pairing_and_no_single_task_windows(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", text)
    assert all(keys.strip() for keys in windows), "a window without partition keys"
    # A key of a few literal values is as good as none.
    assert not any(re.match(r"(measure|kind)#", keys) and "," not in keys for keys in windows), "a window by a key of few values"
    assert "SinglePartition" not in text or "Aggregate(keys=[]" in text or "TakeOrderedAndProject" in text


def test_rates_are_broadcast_and_types_prune_folders(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    text = plan(purchases_in_usd(t.events, t.exchange_rate))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert re.search(r"PartitionFilters: \[.*event_type.*business", text)


def test_scans_read_only_what_is_used(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    text = plan(analytics.ab_test_daily_accounts(t, P))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(session_start", text)
    assert "ReadSchema: struct<account_id:string,session_start:timestamp,app_version:string>" in text


def _loaded_by_day(spark, sf_dir, database):
    star = bronze_from_star(spark, sf_dir)
    load_bronze(spark, {"sessions": star.sessions, "events": star.events}, database)
    return SimpleNamespace(sessions=spark.table(f"{database}.sessions"), events=spark.table(f"{database}.events"))


def test_experiment_reads_only_the_folders_of_its_days(spark, sf_dir):
    t = _loaded_by_day(spark, sf_dir, "plan_days")
    accounts = spark.createDataFrame([], "account_id STRING, acquisition_segment STRING, current_country STRING")
    text = plan(analytics.ab_test_eda(t, accounts, P))
    assert re.search(rf"PartitionFilters: \[[^\]]*session_day#\d+ >= {P.ab_start}", text)
    started = since(t.sessions, "session_start", F.lit(P.ab_start))
    read = {r.f for r in started.select(F.input_file_name().alias("f")).distinct().collect()}
    days = {re.search(r"session_day=([^/]*)", f)[1] for f in t.sessions.inputFiles()}
    assert min(days) < str(P.ab_start)
    assert {re.search(r"session_day=([^/]*)", f)[1] for f in read} == {d for d in days if d >= str(P.ab_start)}


@pytest.mark.parametrize("table, order", [("sessions", ["session_start", "session_id"]), ("events", ["event_date", "event_id"])])
def test_facts_lie_sorted_in_few_files(spark, sf_dir, table, order):
    facts = getattr(_loaded_by_day(spark, sf_dir, f"plan_sorted_{table}"), table)
    keys = [c for c in facts.columns if c.endswith("_day") or c == "event_type"]
    folders = facts.select(*keys).distinct().count()
    # Ranges cut a folder at most once per task.
    assert folders <= len(facts.inputFiles()) <= folders + 4
    for path in facts.inputFiles()[:20]:
        rows = [tuple(r) for r in spark.read.parquet(path).select(*order).coalesce(1).collect()]
        assert rows == sorted(rows)


def test_session_mart_reads_sessions_three_times(spark, sf_dir):
    """Players, the shape of the day and the sessions that acted."""
    t = bronze_from_star(spark, sf_dir)
    text = plan(silver.session_metrics(t, P))
    assert len(re.findall(r"FileScan parquet \[[^\]]*session_start", text)) == 3


def test_offers_are_read_once(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    assert plan(gold.biz_offer_performance(t, P)).count("FileScan") == 1
    assert plan(gold.shop_offer_performance(t, P)).count("FileScan") == 1


def test_account_mart_reads_events_once(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    text = plan(silver.accounts_extended(t, P))
    assert len(re.findall(r"FileScan parquet \[[^\]]*event_metadata", text)) == 1


@pytest.mark.parametrize("name", ["first_event_per_account", "session_rollup"])
def test_raw_events_meet_in_a_hash_table(spark, sf_dir, name):
    """Aggregates that sort their rows see one row per kind of event."""
    text = plan(registry.QUERIES[name](spark, sf_dir))
    sorting = re.findall(r"SortAggregate\(key=\[(.*?)\]", text)
    assert sorting and not any("event_subtype" in keys for keys in sorting)
    assert len(re.findall(r"HashAggregate\(keys=\[[^\]]*event_subtype#\d+[^\]]*\], functions=\[(?:partial_)?m", text)) == 2


@pytest.mark.parametrize("name", ["ab_test_daily_revenue", "paid_ad_views"])
def test_what_is_used_twice_is_stored_first(spark, sf_dir, name):
    """Payloads are parsed once: the plan of the result no longer reads events."""
    t = bronze_from_star(spark, sf_dir)
    if name == "paid_ad_views":
        text = plan(adviews.paid_views(t.events, t.hosted_ads))
    else:
        accounts = spark.createDataFrame([], "account_id STRING, acquisition_segment STRING")
        text = plan(analytics.ab_test_daily_revenue(t, accounts, P))
    assert "event_metadata" not in text
