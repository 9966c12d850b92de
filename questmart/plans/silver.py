"""Silver marts: daily session health, the account view, and interactions with their ads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.functions import segments
from questmart.functions.money import percent, ratio
from questmart.functions.payload import parsed
from questmart.operators.activity import daily_actions, daily_players
from questmart.operators.accounts import event_profile, session_profile, session_bounds
from questmart.operators.currency import purchases_in_usd
from questmart.operators.histograms import quantiles_and_modes
from questmart.params import Params
from questmart.schemas import Bronze


ORIGIN = ("search_query", "ad_name", "campaign_name", "search_ad_keyword", "referral_code", "referral_account_id")


def session_metrics(t: Bronze, params: Params) -> DataFrame:
    """One row per day with sessions. Every joined side is already grouped by day."""
    c = F.col
    dated = t.sessions.withColumn("session_day", F.to_date("session_start"))
    day = ["session_day"]
    paid = (
        purchases_in_usd(t.events, t.exchange_rate)
        .groupBy(c("event_date").alias("session_day"))
        .agg(
            F.sum("usd").alias("total_purchase_rev"),
            F.count_distinct("account_id").alias("purchasing_unique_accounts"),
            F.count("*").alias("total_purchase_events"),
        )
    )
    ads = t.hosted_ad_interactions.groupBy(F.to_date("interaction_time").alias("session_day")).agg(
        F.round(F.sum(c("revenue").cast("decimal(18,6)")), 3).alias("total_ad_rev")
    )
    quantiles = {"p10_ses_dur": 0.10, "p25_ses_dur": 0.25, "p75_ses_dur": 0.75, "p90_ses_dur": 0.90}
    modes = {
        "most_common_device": c("device_model"),
        "most_common_end_reason": c("end_reason"),
        "peak_hour_of_day": F.hour("session_start"),
    }
    joined = daily_players(t.sessions)
    for side in (
        quantiles_and_modes(dated, day, c("duration_seconds"), quantiles, "mdn_ses_dur", modes),
        daily_actions(t.sessions, t.events),
        paid,
        ads,
    ):
        joined = joined.join(side, day, "left")

    def action(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0))

    revenue = c("total_purchase_rev") + c("total_ad_rev")
    players, sessions = c("unique_players"), c("total_sessions")
    return joined.select(
        "session_day",
        F.date_format("session_day", "E").alias("day_of_week"),
        "unique_players",
        "new_accounts",
        "churned_accounts",
        "stopover_accounts",
        "retained_accounts",
        "total_sessions",
        "purchasing_unique_accounts",
        action("sessions_with_purchase").alias("sessions_with_purchase"),
        "total_purchase_events",
        action("adview_unique_accounts").alias("adview_unique_accounts"),
        action("sessions_with_ads").alias("sessions_with_ads"),
        action("total_ad_events").alias("total_ad_events"),
        percent(c("purchasing_unique_accounts"), players).alias("pct_accounts_with_purchase"),
        percent(action("adview_unique_accounts"), players).alias("pct_accounts_with_ad_view"),
        percent(action("sessions_with_purchase"), sessions).alias("pct_sessions_with_purchase"),
        percent(action("sessions_with_ads"), sessions).alias("pct_sessions_with_ad_view"),
        ratio(sessions, players, 2).alias("avg_session_per_player"),
        ratio(c("duration"), c("timed_sessions"), 2).alias("avg_session_duration"),
        ratio(c("hours"), sessions, 2).alias("avg_hour_of_day"),
        "peak_hour_of_day",
        "p10_ses_dur",
        "p25_ses_dur",
        "mdn_ses_dur",
        "p75_ses_dur",
        "p90_ses_dur",
        "ios_count",
        "android_count",
        "ios_unique_accounts",
        "android_unique_accounts",
        percent(c("ios_unique_accounts"), players).alias("pct_ios_users"),
        percent(c("android_unique_accounts"), players).alias("pct_android_users"),
        "most_common_device",
        "most_common_end_reason",
        "total_purchase_rev",
        "total_ad_rev",
        revenue.alias("total_rev"),
        ratio(c("total_purchase_rev"), players, 2).alias("arpu_purchase"),
        ratio(c("total_ad_rev"), players, 3).alias("arpu_ads"),
        ratio(revenue, players, 2).alias("arpu_total"),
        ratio(c("total_purchase_rev"), c("purchasing_unique_accounts"), 2).alias("arppu"),
        ratio(c("total_purchase_rev"), sessions, 2).alias("avg_purc_rev_per_ses"),
        ratio(c("total_ad_rev"), sessions, 3).alias("avg_ad_rev_per_ses"),
        ratio(revenue, sessions, 2).alias("avg_total_rev_per_ses"),
    )


def accounts_extended(t: Bronze, params: Params) -> DataFrame:
    """One row per account with sessions.

    Sessions, events and ad interactions are each reduced to one row per account before the joins, so all joins run
    on account_id between sides already partitioned by it.
    """
    c = F.col
    end_date = F.lit(params.end_date)
    ad_revenue = t.hosted_ad_interactions.groupBy("account_id").agg(F.sum(c("revenue").cast("decimal(18,6)")).alias("ad_revenue"))
    people = t.accounts.select(
        "account_id",
        "username",
        "email",
        "email_is_anonymized",
        "signup_date",
        "referral_source",
        "creation_method",
        parsed(*ORIGIN, payload="acquisition_metadata").alias("origin"),
    )
    joined = (
        session_profile(t.sessions)
        .join(people, "account_id", "left")
        .join(ad_revenue, "account_id", "left")
        .join(event_profile(t.events, t.exchange_rate), "account_id", "left")
        .withColumn("bounds", session_bounds(t.sessions))
    )

    def seen(days: str, low: Column, high: Column, closed_low: bool = False) -> Column:
        after = (lambda d: d >= low) if closed_low else (lambda d: d > low)
        return F.coalesce(F.exists(days, lambda d: after(d.cast("timestamp")) & (d.cast("timestamp") <= high)), F.lit(False))

    signup = c("signup_date")
    plus7, plus30 = signup + F.expr("INTERVAL 7 DAYS"), signup + F.expr("INTERVAL 30 DAYS")
    week = c("latest_week")
    ad_rev = F.coalesce(c("ad_revenue"), F.lit(0))
    return joined.select(
        "account_id",
        "session_count",
        "total_duration",
        "error_count",
        c("latest.region").alias("current_country"),
        c("latest.platform").alias("current_platform"),
        c("latest.device_model").alias("current_device"),
        c("latest.os_version").alias("current_os"),
        c("latest.app_version").alias("current_app_version"),
        c("latest.session_start").alias("latest_session"),
        seen("session_days", signup, plus7).alias("retained_within_7_days"),
        seen("session_days", plus7, plus30).alias("retained_within_30_days"),
        "username",
        "email",
        "email_is_anonymized",
        "signup_date",
        "referral_source",
        "creation_method",
        *[F.coalesce(c(f"origin.{name}"), F.lit("N/A")).alias(name) for name in ORIGIN],
        ad_rev.alias("ad_rev"),
        "first_purchase_date",
        "last_purchase_date",
        seen("purchase_days", signup, plus7, closed_low=True).alias("monetized_within_7_days"),
        F.datediff(end_date, "last_purchase_date").alias("purchase_recency_days"),
        "number_of_purchases",
        "most_purchased_item",
        "total_purchase",
        F.coalesce(ratio(c("total_purchase"), c("number_of_purchases"), 2), F.lit(0)).alias("avg_purchase_value"),
        "last_completed_level",
        segments.acquisition(c("referral_source")).alias("acquisition_segment"),
        segments.monetization(c("total_purchase")).alias("monetization_segment"),
        segments.engagement(week["sessions"], week["mean_duration"], c("bounds")).alias("engagement_segment"),
        segments.churn(week["week_start"], params.churn_cutoff).alias("churn_segment"),
        F.when(c("has_level"), segments.completion(c("last_completed_level"))).alias("completion_segment"),
        segments.subscription(c("last_sub_date"), params.end_date).alias("subscription_status"),
        "subscription_purchases",
        (F.coalesce(c("total_purchase"), F.lit(0)) + ad_rev).alias("ltv"),
        "gold_source_event_count",
        "gold_source_session_count",
        "total_gold_earned",
        "top_gold_earn_reason",
        "total_diamond_earned",
        "top_diamond_earn_reason",
        F.coalesce("total_gold_spent", F.lit(0)).alias("total_gold_spent"),
        F.coalesce("top_gold_spend_reason", F.lit("None")).alias("top_gold_spend_reason"),
        F.coalesce("total_diamond_spent", F.lit(0)).alias("total_diamond_spent"),
        F.coalesce("top_diamond_spend_reason", F.lit("None")).alias("top_diamond_spend_reason"),
        (c("total_gold_earned") - F.coalesce("total_gold_spent", F.lit(0))).alias("current_gold"),
        (c("total_diamond_earned") - F.coalesce("total_diamond_spent", F.lit(0))).alias("current_diamond"),
        *[
            F.coalesce(c(name), F.lit("{}")).alias(name)
            for name in (
                "gold_source_distribution",
                "gold_sink_distribution",
                "diamond_source_distribution",
                "diamond_sink_distribution",
            )
        ],
    )


def hosted_ads_act_detailed(t: Bronze, params: Params) -> DataFrame:
    """Interactions with the attributes of their ad. The ad side is read from storage, so the planner knows its size."""
    ads = t.hosted_ads.select(
        "ad_id",
        "ad_network",
        "pricing_model",
        "value_per_action",
        "start_date",
        "end_date",
        "is_active",
        "advertised_product",
        "ad_length",
        "rewarded",
    )
    return t.hosted_ad_interactions.select(
        "interaction_id",
        "ad_id",
        "interaction_time",
        "interaction_type",
        "revenue",
        "platform",
        "region",
        "device_model",
        "account_id",
    ).join(ads, "ad_id", "left")
