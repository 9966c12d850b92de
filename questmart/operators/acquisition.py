"""Acquisition-side lookups: play rates, campaign cost, referral links, country currencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.functions.payload import parsed
from questmart.operators.marketing import billable
from questmart.sources.literals import literal_table

# Share of installs that become players, per advertiser.
PLAY_RATES = {
    "Google Search Ads": 0.84,
    "Apple Search Ads": 0.82,
    "Google AdMob": 0.90,
    "Facebook Ads": 0.80,
    "TikTok Ads": 0.75,
    "Google Display Network": 0.80,
    "YouTube Ads": 0.87,
    "X Ads": 0.76,
    "Instagram Ads": 0.78,
    "Unity Ads": 0.88,
}

# Country, currency, price multiplier.
COUNTRY_CURRENCIES = [
    ("United States", "USD", 1.0),
    ("India", "INR", 0.5),
    ("Brazil", "BRL", 0.6),
    ("United Kingdom", "GBP", 1.1),
    ("Canada", "CAD", 1.0),
    ("Australia", "AUD", 1.0),
    ("Germany", "EUR", 1.0),
    ("France", "EUR", 1.0),
    ("Italy", "EUR", 1.0),
    ("Japan", "JPY", 0.7),
    ("South Korea", "KRW", 0.7),
    ("Russia", "RUB", 0.5),
    ("Mexico", "MXN", 0.7),
    ("Indonesia", "IDR", 0.4),
    ("Vietnam", "VND", 0.4),
    ("Turkey", "TRY", 0.6),
    ("Philippines", "PHP", 0.5),
    ("Saudi Arabia", "SAR", 0.8),
    ("Thailand", "THB", 0.7),
    ("Malaysia", "MYR", 0.6),
]

# Region, currency, price multiplier, countries without an own currency entry.
REGION_CURRENCIES = [
    ("EU", "EUR", 0.9, [
        "Austria", "Belgium", "Bulgaria", "Croatia", "Cyprus", "Czech Republic", "Denmark", "Estonia",
        "Finland", "France", "Germany", "Greece", "Hungary", "Ireland", "Italy", "Latvia", "Lithuania",
        "Luxembourg", "Malta", "Netherlands", "Poland", "Portugal", "Romania", "Slovakia", "Slovenia", "Spain",
        "Sweden",
    ]),
    ("MEA", "USD", 0.5, [
        "Egypt", "Morocco", "Algeria", "Tunisia", "Libya", "South Africa", "Nigeria", "Kenya", "Ghana", "UAE",
        "Kuwait", "Oman", "Bahrain", "Jordan", "Qatar", "Lebanon", "Iraq",
    ]),
    ("APAC", "USD", 0.6, [
        "Indonesia", "Vietnam", "Thailand", "Malaysia", "Philippines", "Singapore", "Japan", "South Korea",
        "Taiwan", "Pakistan", "Bangladesh", "Sri Lanka", "Nepal", "Myanmar", "Cambodia", "New Zealand",
    ]),
    ("SOAM", "USD", 0.65, [
        "Brazil", "Argentina", "Chile", "Colombia", "Peru", "Ecuador", "Uruguay", "Paraguay", "Bolivia",
        "Venezuela",
    ]),
]
FALLBACK_CURRENCY = ("USD", 1.0)


def campaign_ads(campaigns: DataFrame) -> DataFrame:
    """One row per campaign and ad of its stored id list."""
    ids = F.from_json("associated_ads", "array<int>")
    return campaigns.select("campaign_id", "campaign_name", "acquisition_source", F.explode(ids).alias("ad_id"))


def expected_players(campaigns: DataFrame, ads: DataFrame, play_rates: dict[str, float]) -> DataFrame:
    """Installs of each campaign ad times the play rate of the campaign's advertiser, rounded half to even."""
    spark = campaigns.sparkSession
    rates = literal_table(spark, list(play_rates.items()), {"acquisition_source": "STRING", "play_rate": "DOUBLE"})
    return (
        campaign_ads(campaigns)
        .join(ads.select("ad_id", "ad_name", "launch_date", "install_count"), "ad_id")
        .join(rates, "acquisition_source")
        .select(
            "ad_id",
            "ad_name",
            "campaign_id",
            "campaign_name",
            "launch_date",
            "acquisition_source",
            F.bround((F.col("install_count") * F.col("play_rate")).cast("decimal(18,6)"), 0).alias("install_count"),
        )
    )


def campaign_costs(campaigns: DataFrame, ads: DataFrame) -> DataFrame:
    """Cost of a campaign's ads by their pricing model, and a budget of at least 1000 in whole hundreds."""
    units = billable(
        F.col("pricing_model"), F.col("impression_count"), F.col("click_count"), F.col("install_count"),
        F.col("action_count"), other=F.col("action_count"),
    )
    cost = (units * F.col("cost_per_interaction")).cast("decimal(18,6)")
    priced = ads.select("ad_id", cost.alias("cost"))
    total = F.coalesce(F.sum("cost"), F.lit(0).cast("decimal(18,6)"))
    return (
        campaign_ads(campaigns)
        .join(priced, "ad_id", "left")
        .groupBy("campaign_id")
        .agg(F.count("*").alias("ads"), total.alias("total_cost"))
        .withColumn("budget", F.round(F.greatest("total_cost", F.lit(1000)), -2))
    )


def referral_links(accounts: DataFrame) -> DataFrame:
    """Accounts with the latest account they referred, if any."""
    doc = parsed("referral_account_id", "referral_code", payload="acquisition_metadata")
    referred = (
        accounts.select(F.col("signup_date").alias("referral_timestamp"), F.col("account_id").alias("referred_account"), doc.alias("doc"))
        .select("referral_timestamp", "referred_account", F.col("doc.referral_account_id").alias("account_id"), "doc.referral_code")
        .where(F.col("account_id").isNotNull())
    )
    latest = referred.groupBy("account_id").agg(
        F.max(F.struct("referral_timestamp", "referred_account", "referral_code")).alias("latest")
    )
    return accounts.select("account_id").join(latest, "account_id", "left").select(
        "account_id",
        F.col("latest").isNotNull().alias("referred_friend"),
        "latest.referral_timestamp",
        "latest.referral_code",
    )


def country_currency_table(spark: SparkSession) -> DataFrame:
    """At most one row per country: its own entry, else its region's."""
    own = {country: (currency, multiplier) for country, currency, multiplier in COUNTRY_CURRENCIES}
    regional = {
        country: (currency, multiplier) for _, currency, multiplier, countries in REGION_CURRENCIES for country in countries
    }
    rows = [(country, *entry) for country, entry in {**regional, **own}.items()]
    return literal_table(spark, rows, {"country": "STRING", "currency_name": "STRING", "market_multiplier": "DOUBLE"})


def with_currency(df: DataFrame) -> DataFrame:
    """Adds currency and price multiplier of ``country``; an unlisted country pays in USD."""
    currency, multiplier = FALLBACK_CURRENCY
    joined = df.join(country_currency_table(df.sparkSession), "country", "left")
    return joined.withColumn("currency_name", F.coalesce("currency_name", F.lit(currency))).withColumn(
        "market_multiplier", F.coalesce("market_multiplier", F.lit(multiplier))
    )
