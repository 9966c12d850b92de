"""Gold marts: acquisition, offers, shop, cohorts, ads, levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.functions.money import percent, ratio
from questmart.functions.payload import parsed, shop_sinks
from questmart.operators import marketing
from questmart.operators.cohorts import DAY_OFFSETS, returns_by_cohort
from questmart.operators.currency import purchases_in_usd
from questmart.operators.grains import distinct_by_grain
from questmart.operators.levels import level_attempts, level_funnel
from questmart.params import Params
from questmart.schemas import Bronze

c = F.col


def acquisition_daily(t: Bronze, params: Params) -> DataFrame:
    origin = ("campaign_name", "ad_name", "search_ad_keyword")
    signed_up = t.accounts.select(
        F.to_date("signup_date").alias("date"), "referral_source", parsed(*origin, payload="acquisition_metadata").alias("origin")
    )
    return signed_up.groupBy("date", "referral_source", *[f"origin.{name}" for name in origin]).agg(
        F.count("*").alias("daily_acquired_users")
    )


def biz_offer_performance(t: Bronze, params: Params) -> DataFrame:
    """Offer sales per day with distinct buyers and sessions of the day, its week, its month and overall.

    A NULL offer or category never matches a wider period, so its wider counts are 0.
    """
    sold = purchases_in_usd(t.events, t.exchange_rate)
    counts = distinct_by_grain(
        sold,
        keys=["offer_id", "reward_category"],
        day="event_date",
        entities={"buyers": "account_id", "sessions": "session_id"},
        measures={"total_revenue": c("usd")},
    )
    complete = c("offer_id").isNotNull() & c("reward_category").isNotNull() & c("event_date").isNotNull()

    def wider(name: str) -> Column:
        return F.when(c("offer_id").isNotNull() & c("reward_category").isNotNull() if name.startswith("total") else complete, c(name)).otherwise(0)

    return counts.select(
        "offer_id",
        "event_date",
        "reward_category",
        c("row_count").alias("purchase_count"),
        c("daily_sessions").alias("daily_purchase_sessions"),
        c("daily_buyers").alias("daily_unique_buyers"),
        *[
            wider(f"{grain}_{kind}").alias(f"{grain}_{out}")
            for grain in ("weekly", "monthly", "total")
            for kind, out in (("buyers", "unique_buyers"), ("sessions", "purchase_sessions"))
        ],
        "total_revenue",
        ratio(c("total_revenue"), c("daily_sessions"), 2).alias("avg_revenue_per_purchasing_sessions"),
        ratio(c("total_revenue"), c("daily_buyers"), 2).alias("avg_revenue_per_buyer"),
    )


def shop_offer_performance(t: Bronze, params: Params) -> DataFrame:
    """Currency spent per shop offer and day; a NULL offer or currency leaves the wider counts NULL."""
    counts = distinct_by_grain(
        shop_sinks(t.events),
        keys=["offer_id", "currency_type"],
        day="event_date",
        entities={"sessions": "session_id", "shoppers": "account_id"},
        measures={"total_currency_spent": c("item_amount")},
    )
    keyed = c("offer_id").isNotNull() & c("currency_type").isNotNull()
    dated = keyed & c("event_date").isNotNull()
    return counts.select(
        "offer_id",
        "currency_type",
        "event_date",
        c("row_count").alias("daily_purchase_count"),
        c("daily_sessions").alias("daily_shop_sessions"),
        c("daily_shoppers").alias("daily_unique_shoppers"),
        "total_currency_spent",
        ratio(c("total_currency_spent"), c("daily_sessions"), 2).alias("avg_sink_per_session"),
        ratio(c("total_currency_spent"), c("daily_shoppers"), 2).alias("avg_sink_per_shopper"),
        *[
            F.when(keyed if grain == "total" else dated, c(f"{grain}_{kind}")).alias(f"{grain}_{out}")
            for grain in ("weekly", "monthly", "total")
            for kind, out in (("sessions", "shop_sessions"), ("shoppers", "unique_shoppers"))
        ],
    )


COHORT_KEYS = [
    "signup_day",
    "referral_source",
    "campaign_name",
    "ad_name",
    "search_ad_keyword",
    "acquisition_segment",
    "engagement_segment",
    "monetization_segment",
    "completion_segment",
    "subscription_status",
]


def cohort_churn(t: Bronze, accounts_extended: DataFrame, params: Params) -> DataFrame:
    """Returns, losses and both as percentages of day 0 per signup cohort."""
    cohorts = accounts_extended.select("account_id", F.to_date("signup_date").alias("signup_day"), *COHORT_KEYS[1:])
    returned = returns_by_cohort(cohorts, COHORT_KEYS, "signup_day", t.sessions)
    later = DAY_OFFSETS[1:]
    start = c("day_0")
    back = {n: c(f"day_{n}_return") for n in later}
    return returned.select(
        "*",
        *[(start - back[n]).alias(f"day_{n}_churn") for n in later],
        *[percent(back[n], start).alias(f"retention_rate_day{n}") for n in later],
        *[percent(start - back[n], start).alias(f"churn_rate_day{n}") for n in later],
    )


def hosted_ad_metrics(t: Bronze, params: Params) -> DataFrame:
    """In-game ads by interaction type, with views, revenue, engagement and revenue per thousand views."""
    joined = (
        t.hosted_ads.join(marketing.interaction_counts(t.hosted_ad_interactions), "ad_id", "left")
        .join(marketing.ad_views(t.events), "ad_id", "left")
    )
    unit = F.when(c("pricing_model") == "CPM", c("value_per_action") / 1000).otherwise(c("value_per_action"))
    revenue = F.round((unit * c("interaction_count")).cast("decimal(18,6)"), 2)
    engagement = percent(c("interaction_count"), c("view_count"))
    return joined.select(
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
        "interaction_count",
        "view_count",
        "click_count",
        "install_count",
        "action_count",
        revenue.alias("total_revenue"),
        F.nullif(engagement, F.lit(100)).alias("engagement_rate"),
        ratio(revenue.cast("double") * 1000, c("view_count"), 2).alias("ecpm"),
    )


def level_progression(t: Bronze, params: Params) -> DataFrame:
    return level_funnel(level_attempts(t.events))


def marketing_ad_metrics(t: Bronze, params: Params) -> DataFrame:
    """Acquisition ads per campaign with spend, signups, revenue and efficiency ratios."""
    joined = (
        marketing.ads_with_campaigns(t.ads, t.ad_campaign_map, t.campaigns)
        .join(marketing.signups_by_ad(t.accounts), "ad_name", "left")
        .join(marketing.revenue_by_ad(t.accounts, t.events, t.exchange_rate), "ad_name", "left")
    )
    units = marketing.billable(
        c("campaign_type"), c("impression_count"), c("click_count"), c("install_count"), c("action_count")
    )
    return joined.withColumn("spend", (units * c("cost_per_interaction")).cast("decimal(18,6)")).select(
        "campaign_name",
        "ad_name",
        "campaign_type",
        "impression_count",
        "click_count",
        "install_count",
        "signup_count",
        "action_count",
        "spend",
        F.round("revenue", 2).alias("revenue"),
        percent(c("click_count"), c("impression_count")).alias("ctr"),
        percent(c("install_count"), c("click_count")).alias("cvr"),
        percent(c("install_count"), c("impression_count")).alias("ir"),
        ratio(c("spend"), c("install_count"), 2).alias("ecpi"),
        ratio(c("spend") * 1000, c("impression_count"), 2).alias("ecpm"),
        ratio(c("spend"), c("signup_count"), 2).alias("cpa"),
        ratio(c("revenue"), c("spend"), 2).alias("roas"),
        F.when(c("campaign_type") == "CPA", percent(c("real_addresses"), c("accounts"))).alias("acr"),
    )
