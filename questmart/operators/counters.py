"""Running counters of the early dashboards, as plain grouped counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.functions.payload import key


def level_outcomes(events: DataFrame) -> DataFrame:
    outcome = F.col("event_subtype").isin("level_success", "level_fail")
    return events.where(outcome).groupBy(key("level_id").alias("level")).agg(
        F.count_if(F.col("event_subtype") == "level_success").alias("successes"),
        F.count_if(F.col("event_subtype") == "level_fail").alias("failures"),
    )


def churned_by_day(accounts: DataFrame, sessions: DataFrame) -> DataFrame:
    """Accounts by the number of days between signup and their last session; negative when that lies before signup."""
    last = sessions.groupBy("account_id").agg(F.max(F.to_date("session_start")).alias("last_day"))
    lived = accounts.join(last, "account_id").select(F.datediff("last_day", F.to_date("signup_date")).alias("day"))
    return lived.groupBy("day").agg(F.count("*").alias("churned"))


def activity_by_group(accounts: DataFrame, events: DataFrame, group: str) -> DataFrame:
    """Shop activities (currency spent in the shop) and purchases per account attribute.

    Events are counted per account before they meet the accounts.
    """
    acted = (
        events.where((F.col("event_subtype") == "sink_item") | (F.col("event_type") == "business"))
        .groupBy("account_id")
        .agg(
            F.count_if(F.col("event_subtype") == "sink_item").alias("shop"),
            F.count_if(F.col("event_type") == "business").alias("bought"),
        )
    )
    return acted.join(accounts.select("account_id", group), "account_id").groupBy(group).agg(
        F.sum("shop").alias("shop_activities"), F.sum("bought").alias("monetizations")
    )


def totals(events: DataFrame) -> DataFrame:
    """The four overall counters, one row each."""
    counted = events.agg(
        F.count_if(F.col("event_subtype") == "sink_item").alias("Total Shop Activities"),
        F.count_if(F.col("event_type") == "business").alias("Total Monetizations"),
        F.count_if(F.col("event_subtype") == "level_success").alias("Total Level Successes"),
        F.count_if(F.col("event_subtype") == "level_fail").alias("Total Level Failures"),
    )
    return counted.unpivot([], counted.columns, "metric", "value")


def top_k_with_share(df: DataFrame, label: str, value: str, k: int) -> DataFrame:
    """The k largest values with their share of the k; only k rows leave the tasks."""
    top = df.select(label, value).orderBy(F.desc_nulls_last(value), label).limit(k)
    whole = top.agg(F.sum(value).alias("whole")).scalar()
    return top.withColumn("share", F.when(whole > 0, F.round((F.col(value) / whole * 100).cast("decimal(18,6)"), 1)).otherwise(0))
