"""Segment labels of the account mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Referral sources counted as paid social.
PAID_SOCIAL = ["ad_fb", "ad_gdn", "ad_ig", "ad_in_app", "ad_tk", "ad_x", "ad_yt"]


def engagement(sessions: Column, mean_duration: Column, bounds: Column) -> Column:
    """Latest-week activity against lifetime percentiles; the first matching label wins."""

    def middle(value: Column, low: Column, high: Column) -> Column:
        return (value > low) & (value <= high)

    s33, s66, d33, d66 = bounds["p33_sessions"], bounds["p66_sessions"], bounds["p33_duration"], bounds["p66_duration"]
    return (
        F.when((sessions <= s33) & (mean_duration <= d33), "casual")
        .when(middle(sessions, s33, s66) | middle(mean_duration, d33, d66), "core")
        .when((sessions > s66) | (mean_duration > d66), "hardcore")
        .otherwise("unknown")
    )


def churn(latest_week: Column, cutoff: dt.datetime) -> Column:
    def idle_for(days: int) -> Column:
        return latest_week.cast("timestamp") <= F.lit(cutoff - dt.timedelta(days=days))

    return F.when(idle_for(28), "churned").when(idle_for(14), "dormant").otherwise("active")


def completion(highest_level: Column) -> Column:
    return (
        F.when(highest_level == 100, "completed")
        .when(highest_level > 80, "endgame")
        .when(highest_level > 50, "late_stage")
        .when(highest_level > 20, "mid_stage")
        .otherwise("starter")
    )


def acquisition(referral_source: Column) -> Column:
    return (
        F.when(referral_source.isNull(), "direct")
        .when(referral_source.isin(PAID_SOCIAL), "paid_social")
        .when(referral_source == "ad_search_engine", "paid_search")
        .when(referral_source == "friend_referral", "referral")
        .when(referral_source == "organic_search", "organic")
        .otherwise("unknown")
    )


def monetization(total_purchase: Column) -> Column:
    spent = F.coalesce(total_purchase, F.lit(0))
    return F.when(spent < 1, "minnow").when(spent < 100, "dolphin").when(spent < 500, "whale").otherwise("kraken")


def subscription(last_subscription: Column, today: dt.date) -> Column:
    runs_out = F.date_add(last_subscription, 30)
    return F.when(runs_out >= F.lit(today), "active").when(runs_out < F.lit(today), "inactive").otherwise("never")
