"""Declared schemas of the bronze tables; nothing is inferred on load."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "accounts": (
        "account_id STRING, username STRING, email STRING, email_is_anonymized BOOLEAN, "
        "signup_date TIMESTAMP, country STRING, referral_source STRING, creation_method STRING, "
        "status STRING, acquisition_metadata STRING, device_model STRING, os_version STRING"
    ),
    "events": (
        "event_id BIGINT, event_type STRING, event_subtype STRING, event_date TIMESTAMP, "
        "account_id STRING, session_id BIGINT, event_metadata STRING"
    ),
    "sessions": (
        "session_id BIGINT, account_id STRING, session_start TIMESTAMP, session_end TIMESTAMP, "
        "duration_seconds BIGINT, region STRING, platform STRING, device_model STRING, "
        "os_version STRING, app_version STRING, end_reason STRING"
    ),
    "hosted_ads": (
        "ad_id STRING, ad_network STRING, advertised_product STRING, pricing_model STRING, "
        "value_per_action DOUBLE, start_date DATE, end_date DATE, is_active BOOLEAN, "
        "ad_length INT, rewarded BOOLEAN"
    ),
    "hosted_ad_interactions": (
        "interaction_id BIGINT, account_id STRING, ad_id STRING, interaction_time TIMESTAMP, "
        "interaction_type STRING, revenue DOUBLE, platform STRING, region STRING, device_model STRING"
    ),
    "ads": (
        "ad_id INT, ad_name STRING, studio STRING, launch_date TIMESTAMP, is_active BOOLEAN, "
        "ad_type STRING, acquisition_source STRING, pricing_model STRING, impression_count INT, "
        "click_count INT, install_count INT, action_count INT, cost_per_interaction DOUBLE"
    ),
    "campaigns": (
        "campaign_id INT, campaign_name STRING, start_date TIMESTAMP, end_date TIMESTAMP, "
        "campaign_type STRING, budget DOUBLE, status STRING, acquisition_source STRING, "
        "associated_ads STRING"
    ),
    "ad_campaign_map": (
        "mapping_id INT, ad_id INT, campaign_id INT, association_start TIMESTAMP, association_end TIMESTAMP"
    ),
    "exchange_rate": "currency STRING, usd_exchange_rate DOUBLE, last_updated TIMESTAMP",
}

# Columns that the load step fills in, so files need not carry them.
FILLED_ON_LOAD = {
    "sessions": "duration_seconds",
    "events": "event_id",
    "hosted_ad_interactions": "interaction_id",
}

# Day folders of the stored facts, by the time column they are derived from.
DAY_COLUMNS = {"session_start": "session_day", "event_date": "event_day"}


def since(rows: DataFrame, time: str, start: Column) -> DataFrame:
    """Rows from ``start`` (a date) on. A table stored by day leaves the folders of earlier days unread."""
    wanted = F.col(time) >= start.cast("timestamp")
    if DAY_COLUMNS[time] in rows.columns:
        wanted = wanted & (F.col(DAY_COLUMNS[time]) >= start)
    return rows.where(wanted)


@dataclass(frozen=True)
class Bronze:
    """The nine bronze tables as lazy DataFrames."""

    accounts: DataFrame
    events: DataFrame
    sessions: DataFrame
    hosted_ads: DataFrame
    hosted_ad_interactions: DataFrame
    ads: DataFrame
    campaigns: DataFrame
    ad_campaign_map: DataFrame
    exchange_rate: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str = "bronze") -> "Bronze":
        return cls(**{f.name: spark.table(f"{database}.{f.name}") for f in fields(cls)})
