"""Typed projections of the JSON event payload.

A projection parses the text once into a struct of the keys it needs, instead of once per key. Values keep their JSON
text (numbers and arrays included) and are cast where they are used; a missing key or malformed text gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.functions.money import amount

AD_VIEW_SUBTYPES = ["ad_shown", "reward_ad_shown"]


def parsed(*names: str, payload: str | Column = "event_metadata") -> Column:
    return F.from_json(payload, ", ".join(f"{name} STRING" for name in names))


def key(name: str, payload: str | Column = "event_metadata") -> Column:
    """One key, for projections that need no other."""
    return parsed(name, payload=payload)[name]


def is_ad_view() -> Column:
    return F.col("event_subtype").isin(AD_VIEW_SUBTYPES)


def purchases(events: DataFrame) -> DataFrame:
    """Business events with their offer, reward and cost fields."""
    doc = parsed("offer_id", "reward_id", "reward_category", "cost_type", "currency_name", "cost_amount", "exchange_rate")
    return (
        events.where(F.col("event_type") == "business")
        .select("event_id", "account_id", "session_id", F.to_date("event_date").alias("event_date"), doc.alias("doc"))
        .select(
            "event_id",
            "account_id",
            "session_id",
            "event_date",
            "doc.offer_id",
            "doc.reward_id",
            "doc.reward_category",
            "doc.cost_type",
            "doc.currency_name",
            amount(F.col("doc.cost_amount")).alias("cost_local"),
            amount(F.col("doc.exchange_rate")).alias("event_rate"),
        )
    )


def reason_group(reason: Column) -> Column:
    """Level and tutorial ids fold into one reason each: the word and at least one more character."""
    return (
        F.when(reason.startswith("LEVEL") & (F.length(reason) > 5), "level_progression")
        .when(reason.startswith("TUTORIAL") & (F.length(reason) > 8), "tutorial_progression")
        .otherwise(reason)
    )


def resource_moves(events: DataFrame) -> DataFrame:
    """Resource events with item, amount and grouped reason."""
    doc = parsed("reason", "item_id", "item_amount", "item_category")
    return (
        events.where(F.col("event_type") == "resource")
        .select("event_id", "account_id", "session_id", "event_subtype", F.to_date("event_date").alias("event_date"), doc.alias("doc"))
        .select(
            "event_id",
            "account_id",
            "session_id",
            "event_subtype",
            "event_date",
            reason_group(F.col("doc.reason")).alias("reason"),
            "doc.item_id",
            F.col("doc.item_amount").try_cast("int").alias("item_amount"),
            "doc.item_category",
        )
    )


def shop_sinks(events: DataFrame) -> DataFrame:
    """Currency spent in the in-game shop; the currency is the second part of the item id."""
    doc = parsed("reason", "item_id", "item_amount", "item_category")
    return (
        events.where(F.col("event_subtype") == "sink_item")
        .select("event_id", "account_id", "session_id", F.to_date("event_date").alias("event_date"), doc.alias("doc"))
        .where(F.col("doc.item_category") == "currency")
        .select(
            "event_id",
            "account_id",
            "session_id",
            "event_date",
            F.col("doc.reason").alias("offer_id"),
            F.split_part("doc.item_id", F.lit("_"), F.lit(2)).alias("currency_type"),
            amount(F.col("doc.item_amount")).alias("item_amount"),
        )
    )
