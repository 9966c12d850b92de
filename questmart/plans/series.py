"""Series read from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.functions.catalog import SERIES_OFFERS


def daily_revenue(session_metrics: DataFrame) -> DataFrame:
    return session_metrics.select("session_day", "total_rev")


def daily_acquisition(acquisition_daily: DataFrame) -> DataFrame:
    return acquisition_daily.groupBy(F.col("date").alias("acq_day")).agg(F.sum("daily_acquired_users").alias("dau"))


def daily_event_count(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("event_date").alias("event_day")).agg(F.count("*").alias("events_count"))


def daily_revenue_by_offer(biz_offer_performance: DataFrame, offers: list[str] = SERIES_OFFERS) -> DataFrame:
    """One column per listed offer; a day without sales of an offer holds 0."""
    revenue = F.coalesce("total_revenue", F.lit(0))
    wide = biz_offer_performance.groupBy("event_date").pivot("offer_id", offers).agg(F.sum(revenue))
    return wide.na.fill(0, offers)


def ad_roas_ranking(marketing_ad_metrics: DataFrame) -> DataFrame:
    return marketing_ad_metrics.select("ad_name", "roas").orderBy(F.desc_nulls_last("roas"))
