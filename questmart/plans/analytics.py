"""Analytics marts: the A/B experiment and equipment contribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.functions.money import ratio
from questmart.functions.payload import parsed
from questmart.operators.experiment import account_outcomes, event_rate_purchases, experiment_sessions, running_revenue
from questmart.operators.ordering import with_next
from questmart.params import Params
from questmart.schemas import Bronze, since

c = F.col


def ab_test_daily_accounts(t: Bronze, params: Params) -> DataFrame:
    """Sessions and distinct accounts per day and version since the start of the test."""
    started = since(t.sessions, "session_start", F.lit(params.ab_start))
    per_account = started.groupBy(F.to_date("session_start").alias("session_date"), "account_id").agg(
        F.count_if(c("app_version") == params.control_version).alias("control"),
        F.count_if(c("app_version") == params.test_version).alias("test"),
    )
    known = c("account_id").isNotNull()
    return per_account.groupBy("session_date").agg(
        F.sum("control").alias("control_session_count"),
        F.count_if(known & (c("control") > 0)).alias("control_unique_accounts"),
        F.sum("test").alias("test_session_count"),
        F.count_if(known & (c("test") > 0)).alias("test_unique_accounts"),
    )


def ab_test_daily_revenue(t: Bronze, accounts_extended: DataFrame, params: Params) -> DataFrame:
    """Every priced purchase made in a session of either version, with the group's revenue so far."""
    sales = experiment_sessions(t.sessions, params).join(
        event_rate_purchases(t.events).where(c("cost_usd").isNotNull()), "session_id"
    )
    segments = accounts_extended.select("account_id", "acquisition_segment")
    return running_revenue(sales).join(segments, "account_id", "left").select(
        "group_type",
        "account_id",
        "session_id",
        "acquisition_segment",
        "session_date",
        "offer_id",
        "cost_usd",
        "cumulative_revenue",
    )


def ab_test_eda(t: Bronze, accounts_extended: DataFrame, params: Params) -> DataFrame:
    """Outcome per account and group. Any priced purchase converts, even at zero revenue."""
    zero = F.lit(0)
    people = accounts_extended.select("account_id", "acquisition_segment", "current_country")
    return account_outcomes(t.sessions, t.events, params).join(people, "account_id", "left").select(
        "account_id",
        "group_type",
        "acquisition_segment",
        "current_country",
        "session_count",
        c("revenue").isNotNull().alias("converted"),
        "purchase_count",
        F.coalesce("revenue", zero).alias("total_revenue"),
        F.coalesce(ratio(c("revenue"), c("session_count"), 2), zero).alias("avg_rev_per_ses"),
        F.coalesce(ratio(c("revenue"), c("purchase_count"), 2), zero).alias("avg_rev_per_purc"),
    )


def equipment_contribution_eda(t: Bronze, params: Params) -> DataFrame:
    """Level starts with their equipment and the outcome found in the session's next event.

    Only starts carry their payload through the shuffle; of the others the two score fields are enough. Events of
    equal time follow event_id, then subtype and a hash of the payload.
    """
    own = ["level_id", *[f"equipped_{slot}" for slot in ("hero", "skin", "weapon", "armor", "held_item")]]
    progress = F.when(c("event_type") == "progression", c("event_metadata"))
    start = c("event_subtype") == "level_start"
    events = t.events.select(
        "account_id",
        "session_id",
        "event_date",
        "event_id",
        "event_subtype",
        F.when(start, c("event_metadata")).alias("payload"),
        F.hash("event_metadata").alias("payload_order"),
        parsed("total_score", "stars_gained", payload=progress).alias("score"),
    ).select("*", "score.total_score", "score.stars_gained").drop("score")
    ordered = with_next(
        events,
        keys=["account_id", "session_id"],
        order=["event_date", "event_id", "event_subtype", "payload_order"],
        columns=["event_subtype", "total_score", "stars_gained"],
    )
    return (
        ordered.where(start)
        .withColumn("doc", parsed(*own, payload="payload"))
        .select(
            "event_date",
            *[f"doc.{name}" for name in own],
            F.when(c("next_event_subtype") == "level_success", True)
            .when(c("next_event_subtype") == "level_fail", False)
            .alias("is_attempt_successful"),
            c("next_total_score").alias("total_score"),
            F.coalesce("next_stars_gained", F.lit("0")).alias("stars_gained"),
        )
    )
