"""A/B experiment rows: sessions of the two versions and the purchases made in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questmart.functions.money import usd_at_event
from questmart.functions.payload import purchases
from questmart.params import Params
from questmart.schemas import since
from questmart.session import stage


def experiment_sessions(sessions: DataFrame, params: Params) -> DataFrame:
    """Sessions since the start of the test that ran one of the two versions."""
    group = F.when(F.col("app_version") == params.test_version, "test").when(
        F.col("app_version") == params.control_version, "control"
    )
    started = since(sessions, "session_start", F.lit(params.ab_start))
    return started.where(F.col("app_version").isin(params.test_version, params.control_version)).select("session_id", "account_id", group.alias("group_type"), F.to_date("session_start").alias("session_date"))


def event_rate_purchases(events: DataFrame) -> DataFrame:
    return (
        purchases(events)
        .where(F.col("session_id").isNotNull())
        .select("session_id", "offer_id", usd_at_event(F.col("cost_local"), F.col("event_rate")).alias("cost_usd"))
    )


def running_revenue(sales: DataFrame) -> DataFrame:
    """Revenue of a group up to and including each day; all sales of a day share the value.

    The window runs over days, not sales. The day table holds at most one row per calendar day and group, so it is
    safe to broadcast to the sales. The sales are stored first, as they are read twice: for their days and for themselves.
    """
    sales = stage(sales, "sales")
    daily = sales.groupBy("group_type", "session_date").agg(F.sum("cost_usd").alias("day_revenue"))
    upto = Window.partitionBy("group_type").orderBy("session_date").rowsBetween(Window.unboundedPreceding, 0)
    running = daily.select("group_type", "session_date", F.sum("day_revenue").over(upto).alias("cumulative_revenue"))
    return sales.join(F.broadcast(running), ["group_type", "session_date"])


def account_outcomes(sessions: DataFrame, events: DataFrame, params: Params) -> DataFrame:
    """Sessions, purchases and revenue per account and group. Purchases are reduced per session before the join."""
    bought = (
        event_rate_purchases(events)
        .groupBy("session_id")
        .agg(F.count("offer_id").alias("offers"), F.sum("cost_usd").alias("revenue"))
    )
    return (
        experiment_sessions(sessions, params)
        .join(bought, "session_id", "left")
        .groupBy("account_id", "group_type")
        .agg(
            F.count("session_id").alias("session_count"),
            F.coalesce(F.sum("offers"), F.lit(0)).alias("purchase_count"),
            F.sum("revenue").alias("revenue"),
        )
    )
