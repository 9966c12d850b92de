"""Columns filled on load. Each fill keeps values that are already there, so it may be run again.

``after`` is the highest id in use; rows added later are numbered behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.operators.ordering import assign_dense_ids


def _with_column(df: DataFrame, name: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast("bigint"))


def fill_durations(sessions: DataFrame, after: int = 0) -> DataFrame:
    """Seconds between the whole seconds of start and end, where no duration is given."""
    crossed = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return _with_column(sessions, "duration_seconds").withColumn("duration_seconds", F.coalesce("duration_seconds", crossed))


def fill_event_ids(events: DataFrame, after: int = 0) -> DataFrame:
    """Numbers events by time; equal times follow account, type, subtype and payload."""
    order = ["event_date", "account_id", "event_type", "event_subtype", "event_metadata"]
    return assign_dense_ids(_with_column(events, "event_id"), order, "event_id", "event-ids", after)


def fill_interaction_ids(interactions: DataFrame, after: int = 0) -> DataFrame:
    """Numbers interactions by time; equal times follow account, ad, type and the remaining columns."""
    order = ["interaction_time", "account_id", "ad_id", "interaction_type", "revenue", "platform", "region", "device_model"]
    return assign_dense_ids(_with_column(interactions, "interaction_id"), order, "interaction_id", "interaction-ids", after)


FILLS = {
    "sessions": fill_durations,
    "events": fill_event_ids,
    "hosted_ad_interactions": fill_interaction_ids,
}
