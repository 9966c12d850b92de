"""Level attempts per account and the funnel over levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.functions.money import percent, ratio
from questmart.functions.payload import key


def level_attempts(events: DataFrame) -> DataFrame:
    """Starts, fails and successes per account and level; tutorials and events without a level drop out."""
    return (
        events.where(F.col("event_type") == "progression")
        .select("account_id", "event_subtype", key("level_id").alias("level_id"))
        .where(~F.col("level_id").like("%TUTORIAL%"))
        .groupBy("account_id", "level_id")
        .agg(
            F.count_if(F.col("event_subtype") == "level_start").alias("starts"),
            F.count_if(F.col("event_subtype") == "level_fail").alias("fails"),
            F.count_if(F.col("event_subtype") == "level_success").alias("passes"),
        )
    )


def level_funnel(attempts: DataFrame) -> DataFrame:
    """Fails count as resolved when the same account passes the level; the others leave."""
    c = F.col
    per_level = attempts.groupBy("level_id").agg(
        F.sum("starts").alias("attempt_count"),
        F.sum("passes").alias("success_count"),
        F.sum("fails").alias("fail_count"),
        F.sum(F.when(c("passes") > 0, c("fails"))).alias("resolved_fail_count"),
        F.count("account_id").alias("players"),
    )
    open_ended = c("attempt_count") - (c("success_count") + c("fail_count"))
    return per_level.select(
        "level_id",
        "attempt_count",
        "success_count",
        "fail_count",
        "resolved_fail_count",
        (c("fail_count") - c("resolved_fail_count")).alias("leavers"),
        open_ended.alias("error_count"),
        percent(c("success_count"), c("attempt_count")).alias("completion_rate"),
        percent(c("fail_count"), c("attempt_count")).alias("fail_pct"),
        ratio(open_ended, c("attempt_count"), 3).alias("error_pct"),
        percent(c("resolved_fail_count"), c("attempt_count")).alias("resolved_fail_pct"),
        ratio(c("resolved_fail_count"), c("players"), 2).alias("avg_fail"),
    )
