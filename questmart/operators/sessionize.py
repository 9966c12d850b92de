"""Sessions from login markers, and what follows from event order within an account."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questmart.functions.payload import parsed
from questmart.operators.ordering import assign_dense_ids, with_last_seen

HOUR_MICROS = 60 * 60 * 1_000_000
DAY_MICROS = 24 * HOUR_MICROS


# Places in time order as one number: a date in microseconds, times ID_CODES, plus the code of a 64-bit id (null: 0).
ID_CODES = Decimal(2 * 10**19)
ID_SHIFT = Decimal(2**63 + 1)
NO_DATE = -(10**18)


def time_place(at: str, row_id: str) -> Column:
    """(at, row_id) as a decimal of the same order, nulls first. Of fixed width, so that a hash aggregate can hold the
    least or greatest one; over a struct or string the aggregate would sort its rows."""
    micros = F.coalesce(F.unix_micros(at), F.lit(NO_DATE)).cast("decimal(19,0)")
    code = F.coalesce(F.col(row_id).cast("decimal(20,0)") + F.lit(ID_SHIFT), F.lit(Decimal(0)))
    return (micros * F.lit(ID_CODES) + code).cast("decimal(38,0)")


def parts_of_place(place: Column) -> tuple[Column, Column]:
    """The date and the id of a place."""
    code = F.pmod(place, F.lit(ID_CODES))
    micros = ((place - code) / F.lit(ID_CODES)).cast("bigint")
    row_id = F.when(code > 0, (code - F.lit(ID_SHIFT)).cast("bigint"))
    return F.timestamp_micros(F.nullif(micros, F.lit(NO_DATE).cast("bigint"))), row_id


def _subtype(name: str):
    return (F.col("event_type") == "authentication") & (F.col("event_subtype") == name)


def assign_sessions(events: DataFrame) -> DataFrame:
    """Session id per event: a login opens one, a logout closes it, events outside have NULL.

    Ids number the logins 1..n in global time order. A login while a session is open replaces it; a logout takes the
    session open before it. Equal times follow event_id.
    """
    login, logout = _subtype("user_login"), _subtype("user_logout")
    bare = events.drop("session_id")
    logins = assign_dense_ids(bare.where(login), ["event_date", "event_id", "account_id"], "marker", "logins")
    others = bare.where(~login | login.isNull()).withColumn("marker", F.when(logout, F.lit(0).cast("bigint")))
    marked = with_last_seen(logins.unionByName(others), ["account_id"], ["event_date", "event_id"], "marker")
    session = F.when(logout, F.col("marker_before")).otherwise(F.col("marker_now"))
    return marked.select(*bare.columns, F.nullif(session, F.lit(0)).alias("session_id"))


def session_rollup(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per session: times, device and platform of the login, reason of its end.

    The event before the logout decides the reason: an error gives its subtype, anything else player_exit. A session
    without logout has neither end nor reason.
    """
    login, logout = _subtype("user_login"), _subtype("user_logout")
    device_columns = ("device_model", "os_version", "app_version")
    doc = parsed(*device_columns, payload=F.when(login, F.col("event_metadata")))
    # Strings are keys here, so raw events meet in a hash table; a session has few kinds of events.
    by_kind = (
        events.where(F.col("session_id").isNotNull())
        .withColumn("doc", doc)
        .groupBy("session_id", "account_id", "event_type", "event_subtype", *[F.col(f"doc.{c}").alias(c) for c in device_columns])
        .agg(
            F.min("event_date").alias("first"),
            F.max("event_date").alias("final"),
            F.max(time_place("event_date", "event_id")).alias("place"),
        )
    )
    rolled = by_kind.groupBy("session_id", "account_id").agg(
        F.min(F.when(login, F.col("first"))).alias("session_start"),
        F.max(F.when(logout, F.col("final"))).alias("session_end"),
        *[F.max(c).alias(c) for c in device_columns],
        F.max(F.when(~logout, F.struct("place", "event_type", "event_subtype"))).alias("last"),
    )
    device = F.lower("device_model")
    reason = F.when(F.col("last.event_type") == "error", F.col("last.event_subtype")).otherwise("player_exit")
    return rolled.join(accounts.select("account_id", F.col("country").alias("region")), "account_id", "left").select(
        "session_id",
        "account_id",
        "session_start",
        "session_end",
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        F.when(device.startswith("iphone") | device.startswith("ios"), "iOS").otherwise("Android").alias("platform"),
        "device_model",
        "os_version",
        "app_version",
        F.when(F.col("session_end").isNotNull(), reason).alias("end_reason"),
    )


def first_events(events: DataFrame) -> DataFrame:
    """The earliest event of every account.

    Found per kind of event first, by a hash aggregate that also runs before the shuffle, then among the few kinds of an
    account. Null dates and ids come first, equal places go by type and subtype.
    """
    by_kind = events.groupBy("account_id", "event_type", "event_subtype").agg(F.min(time_place("event_date", "event_id")).alias("place"))
    first = by_kind.groupBy("account_id").agg(F.min(F.struct("place", "event_type", "event_subtype")).alias("first"))
    at, event_id = parts_of_place(F.col("first.place"))
    return first.select("account_id", at.alias("event_date"), event_id.alias("event_id"), "first.event_type", "first.event_subtype")


def recent_offers(purchases: DataFrame) -> DataFrame:
    """Per purchase the offers its account bought in the 24 hours before it.

    A purchase makes its offer recent for the 24 hours that follow. Purchases of one account, offer and hour make one
    such interval; overlapping ones are joined, so at most one row per active hour is left of any number of purchases.
    Purchases then meet the intervals on account and hour, and a join of two plain shuffles splits a busy account's hours.
    """
    at = F.unix_micros("event_time")

    def hour(micros):
        return F.floor(micros / F.lit(HOUR_MICROS))

    by_hour = (
        purchases.where(F.col("offer_id").isNotNull())
        .groupBy("account_id", "offer_id", hour(at).alias("hour"))
        .agg(F.min(at).alias("opens"), (F.max(at) + DAY_MICROS).alias("closes"))
    )
    own = Window.partitionBy("account_id", "offer_id").orderBy("hour")
    reach = F.max("closes").over(own.rowsBetween(Window.unboundedPreceding, -1))
    chained = by_hour.withColumn("fresh", F.coalesce((F.col("opens") > reach).cast("int"), F.lit(1)))
    islands = (
        chained.withColumn("island", F.sum("fresh").over(own))
        .groupBy("account_id", "offer_id", "island")
        .agg(F.min("opens").alias("opens"), F.max("closes").alias("closes"))
    )
    active = islands.select(
        F.col("account_id").alias("_account"),
        F.col("offer_id").alias("_offer"),
        "opens",
        "closes",
        F.explode(F.sequence(hour(F.col("opens")), hour(F.col("closes")))).alias("_hour"),
    )
    rows = purchases.withColumn("_row", F.monotonically_increasing_id()).withColumn("_at", at).withColumn("_in", hour(at))
    match = (
        F.col("account_id").eqNullSafe(F.col("_account"))
        & (F.col("_in") == F.col("_hour"))
        & (F.col("opens") < F.col("_at"))
        & (F.col("_at") <= F.col("closes"))
    )
    met = rows.join(active, match, "left").groupBy("_row", *purchases.columns).agg(F.collect_set("_offer").alias("recent_offers"))
    return met.select(*purchases.columns, F.array_sort("recent_offers").alias("recent_offers"))
