"""Per-account profiles: each reduces its table to one row per account with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.functions.money import amount, usd
from questmart.functions.payload import parsed, reason_group
from questmart.operators.histograms import narrowed_quantiles


def session_bounds(sessions: DataFrame) -> Column:
    """Lifetime percentiles over accounts as one struct of constants, found when the mart is built."""
    per_account = sessions.groupBy("account_id").agg(
        F.count("*").cast("double").alias("sessions"), F.round(F.avg("duration_seconds")).alias("duration")
    )
    measures = ["sessions", "duration"]
    cuts = narrowed_quantiles(per_account, measures, {"p33": 0.33, "p66": 0.66})
    return F.struct(*[F.lit(cuts[m][cut]).cast("double").alias(f"{cut}_{m}") for m in measures for cut in ("p33", "p66")])


def session_profile(sessions: DataFrame) -> DataFrame:
    """Lifetime totals, latest week, latest session and active days per account.

    Equal start times resolve to the higher session id. ``session_days`` holds distinct calendar days only.
    """
    weekly = sessions.groupBy("account_id", F.to_date(F.date_trunc("week", "session_start")).alias("week_start")).agg(
        F.count("*").alias("sessions"),
        F.sum("duration_seconds").alias("duration"),
        F.round(F.avg("duration_seconds")).alias("mean_duration"),
        F.count_if(F.col("end_reason") != "player_exit").alias("errors"),
        F.max(
            F.struct("session_start", "session_id", "region", "platform", "device_model", "os_version", "app_version")
        ).alias("latest"),
        F.collect_set(F.to_date("session_start")).alias("days"),
    )
    return weekly.groupBy("account_id").agg(
        F.sum("sessions").alias("session_count"),
        F.sum("duration").alias("total_duration"),
        F.sum("errors").alias("error_count"),
        F.max("latest").alias("latest"),
        F.max(F.struct("week_start", "sessions", "duration", "mean_duration")).alias("latest_week"),
        F.flatten(F.collect_list("days")).alias("session_days"),
    )


def _facts(events: DataFrame, exchange_rate: DataFrame) -> DataFrame:
    """One (account, kind, value) fact per purchase, currency move or passed level, plus a second one where a
    distinct count or a day list is needed, so that one pass and one grouping serve every figure."""
    business = F.col("event_type") == "business"
    resource = F.col("event_type") == "resource"
    passed = F.col("event_subtype") == "level_success"
    source = F.col("event_subtype").like("source%")
    wanted = events.where(business | passed | (resource & (source | F.col("event_subtype").like("sink%"))))
    doc = parsed("offer_id", "currency_name", "cost_amount", "item_id", "item_amount", "reason", "level_id")
    item = F.col("doc.item_id")
    flow = F.concat(
        F.when(item.like("%gold"), "gold").when(item.like("%diamond"), "diamond").otherwise("other"),
        F.when(source, "_source").otherwise("_sink"),
    )
    facts = (
        wanted.select(
            "account_id", "session_id", "event_type", "event_subtype", F.to_date("event_date").alias("day"), doc.alias("doc")
        )
        .select(
            "account_id",
            "day",
            F.when(business, "offer").when(resource, flow).otherwise("level").alias("kind"),
            F.when(business, F.col("doc.offer_id"))
            .when(resource, reason_group(F.col("doc.reason")))
            .otherwise(F.split_part("doc.level_id", F.lit("_"), F.lit(2)))
            .alias("value"),
            F.when(business, F.col("day").cast("string")).when(resource, F.col("session_id").cast("string")).alias("second"),
            F.when(business, F.col("doc.currency_name")).alias("currency"),
            F.when(business, amount(F.col("doc.cost_amount"))).alias("cost"),
            F.when(resource, F.col("doc.item_amount").try_cast("int")).alias("amount"),
            F.when(passed, F.split_part("doc.level_id", F.lit("_"), F.lit(2)).try_cast("int")).alias("level"),
        )
        .join(exchange_rate.select("currency", "usd_exchange_rate"), "currency", "left")
        .withColumn("usd", usd(F.col("cost"), F.col("usd_exchange_rate")))
    )
    extra = F.when(F.col("kind") == "offer", F.struct(F.lit("purchase_day").alias("kind"), F.col("second").alias("value"))).when(
        F.col("kind").isin("gold_source", "gold_sink", "diamond_source", "diamond_sink") & F.col("second").isNotNull(),
        F.struct(F.concat("kind", F.lit("_session")).alias("kind"), F.col("second").alias("value")),
    )
    main = F.struct("kind", "value")
    facts_of_row = F.when(extra.isNotNull(), F.array(main, extra)).otherwise(F.array(main))
    return facts.select(
        "account_id", "day", "usd", "amount", "level", F.explode(facts_of_row).alias("fact")
    )


def fact_totals(events: DataFrame, exchange_rate: DataFrame) -> DataFrame:
    """Facts added up per (account, kind, value).

    Most facts are alone in a reading task, so they are dealt out first and added up once: hash tables hold what one of the
    session's shuffle partitions holds, not all that a task reads. A busy account is spread over its kinds and values.
    """
    facts = _facts(events, exchange_rate).select("account_id", "fact.kind", "fact.value", "day", "usd", "amount", "level")
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        facts.repartition(tasks, "account_id", "kind", "value")
        .groupBy("account_id", "kind", "value")
        .agg(
            F.count("*").alias("n"),
            F.sum("usd").alias("usd"),
            F.sum("amount").alias("amount"),
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.max("level").alias("level"),
        )
    )


def _of(kind: str, value: Column | str) -> Column:
    return F.when(F.col("kind") == kind, F.col(value) if isinstance(value, str) else value)


def _top(kind: str) -> Column:
    ranked = F.when((F.col("kind") == kind) & F.col("value").isNotNull(), F.struct((-F.col("n")).alias("order"), F.col("value")))
    return F.min(ranked)["value"]


def _distribution(kind: str) -> Column:
    """JSON object reason -> positive total, largest first; reasons form a small fixed vocabulary."""
    kept = (F.col("kind") == kind) & (F.col("amount") > 0) & F.col("value").isNotNull()
    entries = F.array_sort(F.collect_list(F.when(kept, F.struct((-F.col("amount")).alias("order"), F.col("value")))))
    pairs = F.transform(entries, lambda e: F.struct(e["value"].alias("key"), (-e["order"]).alias("value")))
    return F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(pairs)))


def event_profile(events: DataFrame, exchange_rate: DataFrame) -> DataFrame:
    """Purchases, currency flows and progress per account, from one read of the events."""
    subscription = (F.col("kind") == "offer") & F.col("value").like("%subscription%")
    is_offer = F.col("kind") == "offer"
    aggs = [
        F.min(_of("offer", "first_day")).alias("first_purchase_date"),
        F.max(_of("offer", "last_day")).alias("last_purchase_date"),
        F.sum(_of("offer", "n")).alias("number_of_purchases"),
        F.when(F.max(is_offer), F.coalesce(_top("offer"), F.lit("none"))).alias("most_purchased_item"),
        F.sum(_of("offer", "usd")).alias("total_purchase"),
        F.when(F.max(is_offer), F.coalesce(F.sum(F.when(subscription, F.col("n"))), F.lit(0))).alias("subscription_purchases"),
        F.max(F.when(subscription, F.col("last_day"))).alias("last_sub_date"),
        F.collect_list(_of("purchase_day", F.col("value").cast("date"))).alias("purchase_days"),
        F.max(_of("level", "level")).alias("last_completed_level"),
        F.max(F.col("kind") == "level").alias("has_level"),
    ]
    for direction, moved, did, short in (("source", "earned", "earn", "source"), ("sink", "spent", "spend", "spend")):
        present = F.max(F.col("kind").isin([f"{item}_{direction}" for item in ("gold", "diamond", "other")]))
        for item in ("gold", "diamond"):
            kind = f"{item}_{direction}"
            events_of = F.coalesce(F.sum(_of(kind, "n")), F.lit(0))
            sessions_of = F.count_if(F.col("kind") == f"{kind}_session")
            total = F.sum(_of(kind, "amount"))
            aggs += [
                F.when(present, events_of).alias(f"{item}_{short}_event_count"),
                F.when(present, sessions_of).alias(f"{item}_{short}_session_count"),
                (total if direction == "source" else F.when(present, F.coalesce(total, F.lit(0)))).alias(f"total_{item}_{moved}"),
                _top(kind).alias(f"top_{item}_{did}_reason"),
                _distribution(kind).alias(f"{item}_{direction}_distribution"),
            ]
    return fact_totals(events, exchange_rate).groupBy("account_id").agg(*aggs)
