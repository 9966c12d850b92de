"""Layered runs: every mart is built from stored tables and stored, sorted, in one write; the first failure stops the run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from questmart.learning import features, study
from questmart.params import Params
from questmart.plans import analytics, gold, silver
from questmart.schemas import Bronze
from questmart.session import stage
from questmart.sources.files import save_table, write_one
from questmart.stats.report import build_report, render_text


@dataclass(frozen=True)
class Mart:
    layer: str
    name: str
    build: Callable[[Bronze, Params, SparkSession], DataFrame]
    order: list[str]


def _from_bronze(build: Callable[[Bronze, Params], DataFrame]):
    return lambda t, params, spark: build(t, params)


def _with_accounts(build: Callable[[Bronze, DataFrame, Params], DataFrame]):
    return lambda t, params, spark: build(t, spark.table("silver.accounts_extended"), params)


MARTS = [
    Mart("silver", "accounts_extended", _from_bronze(silver.accounts_extended), ["account_id"]),
    Mart("silver", "hosted_ads_act_detailed", _from_bronze(silver.hosted_ads_act_detailed), ["interaction_time", "interaction_id"]),
    Mart("silver", "session_metrics", _from_bronze(silver.session_metrics), ["session_day"]),
    Mart("gold", "acquisition_daily", _from_bronze(gold.acquisition_daily), ["date", "referral_source", "campaign_name", "ad_name", "search_ad_keyword"]),
    Mart("gold", "biz_offer_performance", _from_bronze(gold.biz_offer_performance), ["offer_id", "event_date", "reward_category"]),
    Mart("gold", "cohort_churn", _with_accounts(gold.cohort_churn), ["signup_day", "referral_source", "campaign_name", "ad_name"]),
    Mart("gold", "hosted_ad_metrics", _from_bronze(gold.hosted_ad_metrics), ["ad_id"]),
    Mart("gold", "level_progression", _from_bronze(gold.level_progression), ["level_id"]),
    Mart("gold", "marketing_ad_metrics", _from_bronze(gold.marketing_ad_metrics), ["campaign_name", "ad_name"]),
    Mart("gold", "shop_offer_performance", _from_bronze(gold.shop_offer_performance), ["offer_id", "event_date"]),
    Mart("analytics", "ab_test_daily_accounts", _from_bronze(analytics.ab_test_daily_accounts), ["session_date"]),
    Mart("analytics", "ab_test_daily_revenue", _with_accounts(analytics.ab_test_daily_revenue), ["session_date", "group_type", "acquisition_segment", "session_id"]),
    Mart("analytics", "ab_test_eda", _with_accounts(analytics.ab_test_eda), ["account_id", "group_type"]),
    Mart("analytics", "equipment_contribution_eda", _from_bronze(analytics.equipment_contribution_eda), ["event_date", "level_id"]),
]
LAYERS = ["silver", "gold", "analytics"]


def run_layer(spark: SparkSession, layer: str, params: Params = Params(), bronze: str = "bronze") -> dict[str, int]:
    """Stores the marts of a layer and returns their row counts, which a stored parquet table gives from its footers.

    An Observation on the write would save even that read, but a session that has used one cannot fit MLlib forests
    afterwards: their closures hold the session, which then no longer serialises.
    """
    tables = Bronze.from_catalog(spark, bronze)
    counts = {}
    for mart in (m for m in MARTS if m.layer == layer):
        save_table(mart.build(tables, params, spark), layer, mart.name, order=mart.order)
        counts[mart.name] = spark.table(f"{layer}.{mart.name}").count()
    return counts


def run_pipeline(spark: SparkSession, params: Params = Params(), bronze: str = "bronze") -> dict[str, int]:
    counts = {}
    for layer in LAYERS:
        counts.update(run_layer(spark, layer, params, bronze))
    return counts


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)


def run_ab_report(spark: SparkSession, folder: str) -> DataFrame:
    """Tests on the stored analytics tables; writes the six rows as CSV and as text."""
    report = build_report(
        spark.table("analytics.ab_test_daily_revenue"),
        spark.table("analytics.ab_test_daily_accounts"),
        spark.table("analytics.ab_test_eda"),
    )
    write_one(report.coalesce(1), f"{folder}/ab_test_results", "csv")
    _write_text(spark, render_text(report), f"{folder}/ab_test_results_text")
    return report


def run_studies(spark: SparkSession, folder: str, **options) -> list[study.Run]:
    """All model families on all targets; writes metrics, importances, per-model summaries and a short text."""
    table = features.model_table(spark.table("analytics.equipment_contribution_eda"))
    runs = study.run_suite(stage(features.with_residual(table), "model-table"), **options)
    write_one(study.metrics_table(spark, runs).coalesce(1), f"{folder}/summary/model_metrics", "csv")
    write_one(study.importance_table(spark, runs).coalesce(1), f"{folder}/summary/feature_importance_results", "csv")
    _write_text(spark, "\n".join(study.summary_text(run) for run in runs), f"{folder}/summary/feature_importance_topk")
    for run in runs:
        slug = run.name.lower().replace(" ", "_").replace("-", "")
        write_one(study.importance_table(spark, [run]).coalesce(1), f"{folder}/individual/{slug}_feature_importance", "csv")
        summary = spark.createDataFrame([study.summary_row(run)])
        write_one(summary.coalesce(1), f"{folder}/individual/{slug}_summary", "csv")
    return runs
