"""Paid interactions that follow from ad views and the pricing model of the ad."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.functions.payload import is_ad_view, key
from questmart.session import stage

ONCE_PER_ACCOUNT = ["CPI", "CPA"]


def views(events: DataFrame) -> DataFrame:
    """(account_id, ad_id, event_date) of every ad view."""
    return events.where((F.col("event_type") == "ad") & is_ad_view()).select("account_id", key("ad_id").alias("ad_id"), "event_date")


def _exposed(seen: DataFrame) -> DataFrame:
    return seen.groupBy("account_id", "ad_id").agg(F.count("*").alias("exposure_count"), F.min("event_date").alias("first_view"))


def exposures(events: DataFrame) -> DataFrame:
    """Ad views per account and ad, with the time of the first one."""
    return _exposed(views(events))


def paid_views(events: DataFrame, hosted_ads: DataFrame) -> DataFrame:
    """Interaction type and revenue of each view: CPM and CPC pay per view, CPI and CPA once per account and ad.

    Once-only models are taken from the grouped views, so no account's views need to be ranked. The views are stored
    first: events and their payloads are read once.
    """
    seen = stage(views(events), "ad-views")
    priced = hosted_ads.select("ad_id", "pricing_model", "value_per_action")
    model = F.col("pricing_model")
    kind = (
        F.when(model == "CPM", "view").when(model == "CPC", "click").when(model == "CPI", "install").when(model == "CPA", "action")
    )
    revenue = F.when(model == "CPM", F.col("value_per_action") / 1000).otherwise(F.col("value_per_action"))
    every = (
        seen.withColumnRenamed("event_date", "interaction_time")
        .join(priced.where(model.isin("CPM", "CPC")), "ad_id")
    )
    once = _exposed(seen).withColumnRenamed("first_view", "interaction_time").drop("exposure_count").join(
        priced.where(model.isin(ONCE_PER_ACCOUNT)), "ad_id"
    )
    return every.unionByName(once).select(
        "account_id", "ad_id", "interaction_time", kind.alias("interaction_type"), revenue.alias("revenue")
    )
