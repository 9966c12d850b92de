"""Purchases with their value in USD."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.functions.money import usd, usd_at_event
from questmart.functions.payload import purchases


def purchases_in_usd(events: DataFrame, exchange_rate: DataFrame) -> DataFrame:
    """Adds ``usd`` by the rate table (unknown currency: 1) and ``usd_event`` by the rate in the event.

    The rate table holds one row per currency; its size is known to the planner, which broadcasts it.
    """
    rates = exchange_rate.select(F.col("currency").alias("currency_name"), "usd_exchange_rate")
    return (
        purchases(events)
        .join(rates, "currency_name", "left")
        .withColumn("usd", usd(F.col("cost_local"), F.col("usd_exchange_rate")))
        .withColumn("usd_event", usd_at_event(F.col("cost_local"), F.col("event_rate")))
    )
