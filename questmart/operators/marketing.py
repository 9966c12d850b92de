"""Spend, revenue and efficiency of in-game and acquisition ads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.functions.money import quotient
from questmart.functions.payload import is_ad_view, key, purchases


def billable(model: Column, per_mille_units: Column, clicks: Column, installs: Column, actions: Column, other: Column | None = None) -> Column:
    """Units a pricing model charges for; CPM charges per thousand impressions."""
    units = (
        F.when(model == "CPM", per_mille_units / F.lit(1000.0))
        .when(model == "CPC", clicks.cast("double"))
        .when(model == "CPI", installs.cast("double"))
    )
    if other is not None:
        return units.otherwise(other.cast("double"))
    return units.when(model == "CPA", actions.cast("double"))


def interaction_counts(interactions: DataFrame) -> DataFrame:
    """One row per ad and interaction type, so an ad may appear more than once."""

    def of(kind: str) -> Column:
        return F.count_if(F.col("interaction_type") == kind)

    return interactions.groupBy("ad_id", "interaction_type").agg(
        F.count("*").alias("interaction_count"),
        of("click").alias("click_count"),
        of("install").alias("install_count"),
        of("action").alias("action_count"),
    )


def ad_views(events: DataFrame) -> DataFrame:
    return events.where(is_ad_view()).groupBy(key("ad_id").alias("ad_id")).agg(F.count("*").alias("view_count"))


def ads_with_campaigns(ads: DataFrame, ad_campaign_map: DataFrame, campaigns: DataFrame) -> DataFrame:
    return ads.select(
        "ad_id", "ad_name", "impression_count", "click_count", "install_count", "action_count", "cost_per_interaction"
    ).join(ad_campaign_map.select("ad_id", "campaign_id"), "ad_id", "left").join(
        campaigns.select("campaign_id", "campaign_name", "campaign_type"), "campaign_id", "left"
    )


def acquired_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_id", "email_is_anonymized", key("ad_name", "acquisition_metadata").alias("ad_name")).where(
        F.col("ad_name").isNotNull()
    )


def signups_by_ad(accounts: DataFrame) -> DataFrame:
    """Signups and accounts that gave a real address per ad name; none of the latter stays NULL."""
    return acquired_accounts(accounts).groupBy("ad_name").agg(
        F.count("account_id").alias("signup_count"),
        F.count("*").alias("accounts"),
        F.sum(F.when(~F.col("email_is_anonymized"), 1)).alias("real_addresses"),
    )


def revenue_by_ad(accounts: DataFrame, events: DataFrame, exchange_rate: DataFrame) -> DataFrame:
    """Unrounded USD revenue per ad name; spending is reduced per account before it meets the accounts."""
    spent = (
        purchases(events)
        .select("account_id", F.col("currency_name").alias("currency"), F.col("cost_local").alias("cost"))
        .join(exchange_rate.select("currency", "usd_exchange_rate"), "currency", "left")
        .groupBy("account_id")
        .agg(F.sum(quotient(F.col("cost"), F.coalesce("usd_exchange_rate", F.lit(1.0)))).alias("spent"))
    )
    return acquired_accounts(accounts).join(spent, "account_id").groupBy("ad_name").agg(F.sum("spent").alias("revenue"))
