"""Account activity at day and week level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questmart.functions.payload import is_ad_view


def account_days(sessions: DataFrame) -> DataFrame:
    """One row per account and active day. Every later step works on these, never on raw sessions."""
    return sessions.groupBy("account_id", F.to_date("session_start").alias("session_day")).agg(
        F.count("*").alias("sessions"),
        F.sum("duration_seconds").alias("duration"),
        F.count("duration_seconds").alias("timed_sessions"),
        F.sum(F.hour("session_start").cast("bigint")).alias("hours"),
        F.count_if(F.col("platform") == "iOS").alias("ios"),
        F.count_if(F.col("platform") == "Android").alias("android"),
    )


def day_tags(days: DataFrame) -> DataFrame:
    """Marks an account's first and last active day; a hot account has at most one row per day here."""
    own = Window.partitionBy("account_id")
    known = F.col("account_id").isNotNull()
    return days.select(
        "*",
        (known & (F.col("session_day") == F.min("session_day").over(own))).alias("is_new"),
        (known & (F.col("session_day") == F.max("session_day").over(own))).alias("is_last"),
    )


def daily_players(sessions: DataFrame) -> DataFrame:
    """Players, sessions and player tags per day. Retained players are those neither new nor leaving."""
    tagged = day_tags(account_days(sessions))
    known = F.col("account_id").isNotNull()
    new, last = F.col("is_new"), F.col("is_last")
    return tagged.groupBy("session_day").agg(
        F.count_if(known).alias("unique_players"),
        F.sum("sessions").alias("total_sessions"),
        F.sum("duration").alias("duration"),
        F.sum("timed_sessions").alias("timed_sessions"),
        F.sum("hours").alias("hours"),
        F.sum("ios").alias("ios_count"),
        F.sum("android").alias("android_count"),
        F.count_if(known & (F.col("ios") > 0)).alias("ios_unique_accounts"),
        F.count_if(known & (F.col("android") > 0)).alias("android_unique_accounts"),
        F.count_if(new).alias("new_accounts"),
        F.count_if(last).alias("churned_accounts"),
        F.count_if(new & last).alias("stopover_accounts"),
        F.count_if(known & ~new & ~last).alias("retained_accounts"),
    )


def session_actions(events: DataFrame) -> DataFrame:
    """Purchases and ad views per session and account, reduced before they meet the sessions."""
    wanted = events.where(
        F.col("session_id").isNotNull() & ((F.col("event_type") == "business") | ((F.col("event_type") == "ad") & is_ad_view()))
    )
    return wanted.groupBy("session_id", F.col("account_id").alias("actor")).agg(
        F.count_if(F.col("event_type") == "business").alias("purchases"),
        F.count_if(F.col("event_type") == "ad").alias("ad_views"),
    )


def daily_actions(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Sessions with purchases or ad views, ad viewers and ad views per session day; only days with an action."""
    acted = sessions.select("session_id", F.to_date("session_start").alias("session_day")).join(
        session_actions(events), "session_id"
    )
    return acted.groupBy("session_day").agg(
        F.count_distinct(F.when(F.col("purchases") > 0, F.col("session_id"))).alias("sessions_with_purchase"),
        F.count_distinct(F.when(F.col("ad_views") > 0, F.col("session_id"))).alias("sessions_with_ads"),
        F.count_distinct(F.when(F.col("ad_views") > 0, F.col("actor"))).alias("adview_unique_accounts"),
        F.sum(F.when(F.col("actor").isNotNull(), F.col("ad_views")).otherwise(0)).alias("total_ad_events"),
    )
