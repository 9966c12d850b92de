"""Operators outside the marts, over the bronze roles and the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from questmart.functions.payload import key
from questmart.operators import acquisition, adviews, counters, ordering, sessionize
from questmart.operators.accounts import event_profile
from questmart.operators.experiment import account_outcomes
from questmart.params import Params
from questmart.plans import analytics, gold, silver
from questmart.session import new_stage_path, stage
from questmart.sources import files, health
from questmart.sources.star_tables import bronze_from_star, read_star
from questmart.stats import samples
from questmart.stats.report import STATISTICS, build_report, build_statistics
from verification.mart_queries import ACCOUNT_CTES, ACCOUNT_ROLES, EDA, P, _TRIAL
from verification.registry import query
from verification.sql_parts import SPENDING, ratio, text

# ---------------------------------------------------------------- bronze fills


@query(
    "filled_durations",
    "SELECT session_id, CASE WHEN session_id % 3 = 0 THEN duration_seconds ELSE date_diff('second', session_start, session_end) END AS duration_seconds FROM sessions",
    ("sessions",),
)
def _filled_durations(spark, sf_dir):
    holes = bronze_from_star(spark, sf_dir).sessions.withColumn(
        "duration_seconds", F.when(F.col("session_id") % 3 == 0, F.col("duration_seconds"))
    )
    return health.fill_durations(holes).select("session_id", "duration_seconds")


@query(
    "global_event_ids",
    f"""
SELECT {text('event_date')}, account_id, event_type, event_subtype,
       row_number() OVER (ORDER BY event_date, account_id, event_type, event_subtype, event_metadata) AS event_id
FROM stream""",
    ("stream",),
)
def _global_event_ids(spark, sf_dir):
    numbered = health.fill_event_ids(bronze_from_star(spark, sf_dir).stream.drop("event_id"))
    return numbered.select("event_date", "account_id", "event_type", "event_subtype", "event_id")


@query(
    "global_interaction_ids",
    f"""
SELECT {text('interaction_time')}, account_id, ad_id, interaction_type, revenue,
       row_number() OVER (ORDER BY interaction_time, account_id, ad_id, interaction_type, revenue, platform, region, device_model) AS interaction_id
FROM hosted_ad_interactions""",
    ("hosted_ad_interactions",),
)
def _global_interaction_ids(spark, sf_dir):
    numbered = health.fill_interaction_ids(bronze_from_star(spark, sf_dir).hosted_ad_interactions.drop("interaction_id"))
    return numbered.select("interaction_time", "account_id", "ad_id", "interaction_type", "revenue", "interaction_id")


# ---------------------------------------------------------------- sessions from events

SESSIONISED = """
flagged AS (SELECT *, event_subtype = 'user_login' AS is_in, event_subtype = 'user_logout' AS is_out FROM stream),
numbered AS (SELECT *, CASE WHEN is_in THEN sum(CASE WHEN is_in THEN 1 ELSE 0 END) OVER (ORDER BY event_date, event_id) END AS login_no FROM flagged),
carried AS (
    SELECT *, last_value(CASE WHEN is_out THEN 0 ELSE login_no END IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY event_date, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_now,
           last_value(CASE WHEN is_out THEN 0 ELSE login_no END IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY event_date, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_before
    FROM numbered),
in_session AS (SELECT event_id, event_type, event_subtype, event_date, account_id, event_metadata,
                      CAST(NULLIF(CASE WHEN is_out THEN open_before ELSE open_now END, 0) AS BIGINT) AS session_id FROM carried)"""


@query(
    "sessionised_events",
    f"WITH {SESSIONISED} SELECT event_id, account_id, event_subtype, {text('event_date')}, session_id FROM in_session",
    ("stream",),
)
def _sessionised_events(spark, sf_dir):
    events = sessionize.assign_sessions(bronze_from_star(spark, sf_dir).stream)
    return events.select("event_id", "account_id", "event_subtype", "event_date", "session_id")


@query(
    "session_rollup",
    f"""
WITH {SESSIONISED},
opened AS (SELECT * FROM in_session WHERE event_subtype = 'user_login'),
closed AS (SELECT session_id, max(event_date) AS at FROM in_session WHERE event_subtype = 'user_logout' AND session_id IS NOT NULL GROUP BY ALL),
final AS (SELECT session_id, event_type, event_subtype FROM in_session WHERE event_subtype <> 'user_logout' AND session_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY event_date DESC, event_id DESC) = 1)
SELECT o.session_id, o.account_id, {text('o.event_date', 'session_start')}, {text('c.at', 'session_end')}, COALESCE(a.country, 'Unknown') AS region,
       CASE WHEN lower(o.event_metadata ->> '$.device_model') LIKE 'iphone%' OR lower(o.event_metadata ->> '$.device_model') LIKE 'ios%'
            THEN 'iOS' ELSE 'Android' END AS platform,
       o.event_metadata ->> '$.device_model' AS device_model, o.event_metadata ->> '$.os_version' AS os_version,
       o.event_metadata ->> '$.app_version' AS app_version,
       CASE WHEN c.at IS NOT NULL THEN CASE WHEN f.event_type = 'error' THEN f.event_subtype ELSE 'player_exit' END END AS end_reason
FROM opened o LEFT JOIN closed c ON c.session_id = o.session_id LEFT JOIN final f ON f.session_id = o.session_id
     LEFT JOIN accounts a ON a.account_id = o.account_id""",
    ("stream", "accounts"),
)
def _session_rollup(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return sessionize.session_rollup(sessionize.assign_sessions(t.stream), t.accounts)


@query(
    "first_event_per_account",
    f"""
SELECT account_id, {text('event_date')}, event_id, event_type, event_subtype FROM stream
QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY event_date, event_id) = 1""",
    ("stream",),
)
def _first_events(spark, sf_dir):
    return sessionize.first_events(bronze_from_star(spark, sf_dir).stream)


@query(
    "recent_offers_24h",
    f"""
WITH bought AS (SELECT event_id, account_id, event_date AS event_time, event_metadata ->> '$.offer_id' AS offer_id FROM stream WHERE event_type = 'business')
SELECT p.event_id, p.account_id, {text('p.event_time')}, p.offer_id, COALESCE(string_agg(DISTINCT q.offer_id, ',' ORDER BY q.offer_id), '') AS recent_offers
FROM bought p LEFT JOIN bought q ON q.account_id = p.account_id AND q.event_time < p.event_time AND q.event_time >= p.event_time - INTERVAL 24 HOURS
GROUP BY ALL""",
    ("stream",),
)
def _recent_offers(spark, sf_dir):
    stream = bronze_from_star(spark, sf_dir).stream
    bought = stream.where(F.col("event_type") == "business").select(
        "event_id", "account_id", F.col("event_date").alias("event_time"), key("offer_id").alias("offer_id")
    )
    return sessionize.recent_offers(bought).withColumn("recent_offers", F.concat_ws(",", "recent_offers"))


@query(
    "next_event_in_account",
    f"""
SELECT event_id, account_id, lead(event_subtype) OVER w AS next_event_subtype, {text('lead(event_date) OVER w', 'next_event_date')}
FROM stream WINDOW w AS (PARTITION BY account_id ORDER BY event_date, event_id)""",
    ("stream",),
)
def _next_event(spark, sf_dir):
    nexts = ordering.with_next(
        bronze_from_star(spark, sf_dir).stream, ["account_id"], ["event_date", "event_id"], ["event_subtype", "event_date"]
    )
    return nexts.select("event_id", "account_id", "next_event_subtype", "next_event_date")


# ---------------------------------------------------------------- acquisition and ads

_COUNTRIES = ["United States", "India", "Spain", "Kenya", "Chile", "Japan", "Norway", "Germany", "Taiwan", "Brazil", "Turkey", "Ghana", "Iceland"]
_COUNTRY_SQL = "CASE c_nationkey % 13 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_COUNTRIES)) + " END"


@query(
    "country_currency",
    f"""
WITH own AS (SELECT * FROM (VALUES {', '.join(str(row) for row in acquisition.COUNTRY_CURRENCIES)}) v(country, cur, mult)),
regional AS (SELECT unnest(string_split(names, ', ')) AS country, cur, mult
             FROM (VALUES {', '.join(str((cur, mult, ', '.join(names))) for _, cur, mult, names in acquisition.REGION_CURRENCIES)}) v(cur, mult, names))
SELECT c.c_custkey AS customer, c.country, COALESCE(o.cur, r.cur, 'USD') AS currency_name, CAST(COALESCE(o.mult, r.mult, 1.0) AS DOUBLE) AS market_multiplier
FROM (SELECT c_custkey, {_COUNTRY_SQL} AS country FROM customer) c
LEFT JOIN own o ON o.country = c.country LEFT JOIN regional r ON r.country = c.country""",
)
def _country_currency(spark, sf_dir):
    people = read_star(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer"), F.expr(_COUNTRY_SQL).alias("country")
    )
    return acquisition.with_currency(people).select("customer", "country", "currency_name", "market_multiplier")


_STAR_RATES = {"src0": 0.84, "src1": 0.75, "src2": 0.9}
_RATE_ROWS = ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in _STAR_RATES.items())
_MEMBERS = "members AS (SELECT campaign_id, campaign_name, acquisition_source, unnest(CAST(json(associated_ads) AS INT[])) AS ad_id FROM campaigns)"


@query(
    "campaign_expected_players",
    f"""
WITH {_MEMBERS}
SELECT CAST(a.ad_id AS BIGINT) AS ad_id, a.ad_name, CAST(m.campaign_id AS BIGINT) AS campaign_id, m.campaign_name, {text('a.launch_date')}, m.acquisition_source,
       CAST(round_even(CAST(a.install_count * r.rate AS DECIMAL(18,6)), 0) AS DOUBLE) AS install_count
FROM members m JOIN ads a ON a.ad_id = m.ad_id JOIN (VALUES {_RATE_ROWS}) r(src, rate) ON r.src = m.acquisition_source""",
    ("campaigns", "ads"),
)
def _expected_players(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return acquisition.expected_players(t.campaigns, t.ads, _STAR_RATES)


@query(
    "campaign_costs",
    f"""
WITH {_MEMBERS},
cost AS (SELECT ad_id, CAST(cost_per_interaction * CASE pricing_model WHEN 'CPM' THEN impression_count / 1000 WHEN 'CPC' THEN click_count
                WHEN 'CPI' THEN install_count ELSE action_count END AS DECIMAL(18,6)) AS cost FROM ads)
SELECT CAST(campaign_id AS BIGINT) AS campaign_id, count(*) AS ads, CAST(COALESCE(sum(cost), 0) AS DOUBLE) AS total_cost,
       CAST(round(greatest(COALESCE(sum(cost), 0), 1000) / 100) * 100 AS DOUBLE) AS budget
FROM members LEFT JOIN cost USING (ad_id) GROUP BY campaign_id""",
    ("campaigns", "ads"),
)
def _campaign_costs(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return acquisition.campaign_costs(t.campaigns, t.ads)


@query(
    "referral_links",
    f"""
WITH referred AS (SELECT acquisition_metadata ->> '$.referral_account_id' AS by_account, signup_date, account_id, acquisition_metadata ->> '$.referral_code' AS code
                  FROM accounts WHERE acquisition_metadata ->> '$.referral_account_id' IS NOT NULL
                  QUALIFY row_number() OVER (PARTITION BY by_account ORDER BY signup_date DESC, account_id DESC) = 1)
SELECT a.account_id, r.by_account IS NOT NULL AS referred_friend, {text('r.signup_date', 'referral_timestamp')}, r.code AS referral_code
FROM accounts a LEFT JOIN referred r ON r.by_account = a.account_id""",
    ("accounts",),
)
def _referral_links(spark, sf_dir):
    return acquisition.referral_links(bronze_from_star(spark, sf_dir).accounts)


_VIEWS = """
seen AS (SELECT account_id, event_metadata ->> '$.ad_id' AS ad_id, event_date FROM events_role
         WHERE event_type = 'ad' AND event_subtype IN ('ad_shown', 'reward_ad_shown'))"""


@query(
    "ad_exposures",
    f"WITH {_VIEWS} SELECT account_id, ad_id, count(*) AS exposure_count, {text('min(event_date)', 'first_view')} FROM seen GROUP BY account_id, ad_id",
    ("events",),
)
def _exposures(spark, sf_dir):
    return adviews.exposures(bronze_from_star(spark, sf_dir).events)


@query(
    "paid_ad_views",
    f"""
WITH {_VIEWS},
priced AS (SELECT s.*, h.pricing_model AS model, h.value_per_action AS v, row_number() OVER (PARTITION BY s.account_id, s.ad_id ORDER BY event_date) AS nth
           FROM seen s JOIN hosted_ads h ON h.ad_id = s.ad_id)
SELECT account_id, ad_id, {text('event_date', 'interaction_time')},
       CASE model WHEN 'CPM' THEN 'view' WHEN 'CPC' THEN 'click' WHEN 'CPI' THEN 'install' ELSE 'action' END AS interaction_type,
       CASE WHEN model = 'CPM' THEN v / 1000 ELSE v END AS revenue
FROM priced WHERE model IN ('CPM', 'CPC') OR (model IN ('CPI', 'CPA') AND nth = 1)""",
    ("events", "hosted_ads"),
)
def _paid_views(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return adviews.paid_views(t.events, t.hosted_ads)


# ---------------------------------------------------------------- counters, rankings, unions


@query(
    "counter_level_outcomes",
    """
SELECT event_metadata ->> '$.level_id' AS level, count(*) FILTER (event_subtype = 'level_success') AS successes,
       count(*) FILTER (event_subtype = 'level_fail') AS failures
FROM events_role WHERE event_subtype IN ('level_success', 'level_fail') GROUP BY ALL""",
    ("events",),
)
def _level_outcomes(spark, sf_dir):
    return counters.level_outcomes(bronze_from_star(spark, sf_dir).events)


@query(
    "counter_churned_by_day",
    """
SELECT lived AS day, count(*) AS churned
FROM (SELECT max(CAST(s.session_start AS DATE)) - CAST(a.signup_date AS DATE) AS lived FROM accounts a JOIN sessions s USING (account_id)
      GROUP BY a.account_id, a.signup_date) GROUP BY lived""",
    ("accounts", "sessions"),
)
def _churned_by_day(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return counters.churned_by_day(t.accounts, t.sessions)


@query(
    "counter_activity_by_group",
    """
SELECT a.creation_method, count(*) FILTER (e.event_subtype = 'sink_item') AS shop_activities, count(*) FILTER (e.event_type = 'business') AS monetizations
FROM accounts a JOIN events_role e ON e.account_id = a.account_id WHERE e.event_subtype = 'sink_item' OR e.event_type = 'business' GROUP BY ALL""",
    ("accounts", "events"),
)
def _activity_by_group(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return counters.activity_by_group(t.accounts, t.events, "creation_method")


@query(
    "counter_totals",
    """
SELECT metric, count(*) AS value
FROM (SELECT CASE WHEN event_subtype = 'sink_item' THEN 'Total Shop Activities' WHEN event_type = 'business' THEN 'Total Monetizations'
                  WHEN event_subtype = 'level_success' THEN 'Total Level Successes' WHEN event_subtype = 'level_fail' THEN 'Total Level Failures' END AS metric
      FROM events_role) WHERE metric IS NOT NULL GROUP BY metric""",
    ("events",),
)
def _counter_totals(spark, sf_dir):
    return counters.totals(bronze_from_star(spark, sf_dir).events)


@query(
    "top_levels_by_failures",
    """
WITH ranked AS (SELECT event_metadata ->> '$.level_id' AS level, count(*) FILTER (event_subtype = 'level_fail') AS failures
                FROM events_role WHERE event_subtype IN ('level_success', 'level_fail') GROUP BY ALL ORDER BY failures DESC, level LIMIT 3)
SELECT level, failures, CAST(round(CAST(CAST(failures AS DOUBLE) / sum(failures) OVER () * 100 AS DECIMAL(18,6)), 1) AS DOUBLE) AS share FROM ranked""",
    ("events",),
)
def _top_levels(spark, sf_dir):
    return counters.top_k_with_share(counters.level_outcomes(bronze_from_star(spark, sf_dir).events), "level", "failures", 3)


@query(
    "merged_event_streams",
    f"""
SELECT {text('day')}, event_type, count(*) AS events
FROM (SELECT CAST(event_date AS DATE) AS day, event_type FROM events_role UNION ALL SELECT CAST(event_date AS DATE), event_type FROM stream)
GROUP BY day, event_type""",
    ("events", "stream"),
)
def _merged_streams(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return t.events.unionByName(t.stream).groupBy(F.to_date("event_date").alias("day"), "event_type").agg(F.count("*").alias("events"))


@query(
    "latest_sessions_preview",
    f"SELECT session_id, account_id, {text('session_start')} FROM sessions ORDER BY sessions.session_start DESC, session_id LIMIT 5",
    ("sessions",),
)
def _preview(spark, sf_dir):
    ordered = bronze_from_star(spark, sf_dir).sessions.select("session_id", "account_id", "session_start").orderBy(
        F.desc("session_start"), "session_id"
    )
    return files.preview(ordered, 5)


# ---------------------------------------------------------------- account parts

_FLOW_NAMES = [
    f"{item}_{short}_{what}_count" for short in ("source", "spend") for item in ("gold", "diamond") for what in ("event", "session")
]


@query(
    "account_currency_flows",
    f"""
WITH {ACCOUNT_CTES}
SELECT p.account_id, i.gold_events AS gold_source_event_count, i.gold_sessions AS gold_source_session_count,
       i.diamond_events AS diamond_source_event_count, i.diamond_sessions AS diamond_source_session_count,
       o.gold_events AS gold_spend_event_count, o.gold_sessions AS gold_spend_session_count,
       o.diamond_events AS diamond_spend_event_count, o.diamond_sessions AS diamond_spend_session_count,
       CAST(i.gold AS BIGINT) AS total_gold_earned, CAST(i.diamond AS BIGINT) AS total_diamond_earned,
       CASE WHEN o.account_id IS NOT NULL THEN CAST(COALESCE(o.gold, 0) AS BIGINT) END AS total_gold_spent,
       CASE WHEN o.account_id IS NOT NULL THEN CAST(COALESCE(o.diamond, 0) AS BIGINT) END AS total_diamond_spent,
       i.gold_reason AS top_gold_earn_reason, i.diamond_reason AS top_diamond_earn_reason,
       o.gold_reason AS top_gold_spend_reason, o.diamond_reason AS top_diamond_spend_reason
FROM (SELECT DISTINCT account_id FROM moves) p
LEFT JOIN flows i ON i.account_id = p.account_id AND i.direction = 'source' LEFT JOIN flows o ON o.account_id = p.account_id AND o.direction = 'sink'""",
    ACCOUNT_ROLES,
)
def _currency_flows(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    profile = event_profile(t.events.where(F.col("event_type") == "resource"), t.exchange_rate)
    totals = [f"total_{i}_{w}" for i in ("gold", "diamond") for w in ("earned", "spent")]
    tops = [f"top_{i}_{w}_reason" for i in ("gold", "diamond") for w in ("earn", "spend")]
    return profile.select("account_id", *_FLOW_NAMES, *totals, *tops)


@query(
    "account_purchases",
    f"""
WITH {ACCOUNT_CTES}
SELECT account_id, {text('first_day', 'first_purchase_date')}, {text('last_day', 'last_purchase_date')}, n AS number_of_purchases,
       favourite AS most_purchased_item, CAST(total AS DOUBLE) AS total_purchase, subs AS subscription_purchases, {text('last_sub', 'last_sub_date')}
FROM buys""",
    ACCOUNT_ROLES,
)
def _account_purchases(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    profile = event_profile(t.events.where(F.col("event_type") == "business"), t.exchange_rate)
    return profile.select(
        "account_id", "first_purchase_date", "last_purchase_date", "number_of_purchases", "most_purchased_item",
        "total_purchase", "subscription_purchases", "last_sub_date",
    )


# ---------------------------------------------------------------- files


@query("csv_round_trip", "SELECT * REPLACE (CAST(signup_date AS VARCHAR) AS signup_date) FROM accounts", ("accounts",))
def _csv_round_trip(spark, sf_dir):
    folder = new_stage_path(spark, "csv")
    written = files.write_tables({"accounts": bronze_from_star(spark, sf_dir).accounts}, folder)
    return files.read_csv_table(spark, written["accounts"], "accounts")


@query(
    "parquet_append",
    f"SELECT session_id, account_id, {text('session_start')}, n FROM sessions, (VALUES (1), (2)) twice(n)".replace(", n FROM", ", CAST(n AS BIGINT) AS n FROM"),
    ("sessions",),
)
def _parquet_append(spark, sf_dir):
    table = f"append_{uuid.uuid4().hex}"
    sessions = bronze_from_star(spark, sf_dir).sessions.select("session_id", "account_id", "session_start")
    files.save_table(sessions.withColumn("n", F.lit(1)), "default", table)
    # Columns in another order are matched by name.
    files.save_table(sessions.select(F.lit(2).alias("n"), *reversed(sessions.columns)), "default", table, "append")
    return spark.table(f"default.{table}")


@query(
    "normalised_columns",
    """
SELECT o_orderkey, '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS labels,
       '{"status":"' || o_orderstatus || '","customer":' || o_custkey || '}' AS detail,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price
FROM orders""",
)
def _normalised(spark, sf_dir):
    orders = read_star(spark, sf_dir, "orders")
    nested = orders.select(
        "o_orderkey",
        F.array("o_orderstatus", "o_orderpriority").alias("labels"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer")).alias("detail"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).otherwise(F.lit(float("nan"))).alias("price"),
    )
    return files.normalize(nested)


@query("chronological_sessions", f"SELECT session_id, {text('session_start')} FROM sessions", ("sessions",))
def _chronological(spark, sf_dir):
    path = new_stage_path(spark, "chronological")
    sessions = bronze_from_star(spark, sf_dir).sessions.select("session_id", "session_start")
    files.write_chronological(sessions, path, ["session_start", "session_id"])
    return spark.read.parquet(path)


# ---------------------------------------------------------------- experiment statistics


def _experiment(spark, sf_dir):
    """The three analytics tables of the report, stored once."""
    t = bronze_from_star(spark, sf_dir)
    people = silver.accounts_extended(t, P)
    return (
        stage(analytics.ab_test_daily_revenue(t, people, P), "daily-revenue"),
        stage(analytics.ab_test_daily_accounts(t, P), "daily-accounts"),
        stage(analytics.ab_test_eda(t, people, P), "account-level"),
    )


@query(
    "ab_arpdau",
    f"""
WITH {SPENDING}, {_TRIAL},
rev AS (SELECT s.day, sum(p.usd_event) FILTER (s.side = 'control') AS control, sum(p.usd_event) FILTER (s.side = 'test') AS test
        FROM trial s JOIN spending p ON p.session_id = s.session_id WHERE p.usd_event IS NOT NULL AND s.side IS NOT NULL GROUP BY ALL),
acc AS (SELECT day, count(DISTINCT account_id) FILTER (side = 'control') AS c, count(DISTINCT account_id) FILTER (side = 'test') AS t FROM trial GROUP BY ALL)
SELECT {text('a.day', 'session_date')}, CAST(r.control AS DOUBLE) AS control_revenue, CAST(r.test AS DOUBLE) AS test_revenue,
       a.c AS control_unique_accounts, a.t AS test_unique_accounts,
       CAST(r.control AS DOUBLE) / NULLIF(a.c, 0) AS control_arpdau, CAST(r.test AS DOUBLE) / NULLIF(a.t, 0) AS test_arpdau
FROM acc a JOIN rev r ON r.day = a.day""",
    ("sessions", "events", "exchange_rate"),
)
def _ab_arpdau(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    people = silver.accounts_extended(t, P)
    return samples.arpdau(analytics.ab_test_daily_revenue(t, people, P), analytics.ab_test_daily_accounts(t, P))


@query(
    "ab_conversion_counts",
    f"WITH {EDA} SELECT group_type, count(*) AS accounts, count(*) FILTER (converted) AS converted FROM eda GROUP BY ALL",
    ACCOUNT_ROLES,
)
def _ab_conversion(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return samples.conversion_counts(analytics.ab_test_eda(t, silver.accounts_extended(t, P), P))


def _revenue_sample(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return account_outcomes(t.sessions, t.events, P).select(
        F.col("group_type").alias("side"), F.coalesce("revenue", F.lit(0)).cast("double").alias("x")
    )


_SAMPLE = f"""
{SPENDING}, {_TRIAL},
sample AS (SELECT s.side, CAST(COALESCE(sum(p.usd_event), 0) AS DOUBLE) AS x FROM trial s LEFT JOIN spending p ON p.session_id = s.session_id
           WHERE s.side IS NOT NULL GROUP BY s.side, s.account_id)"""
_SAMPLE_ROLES = ("sessions", "events", "exchange_rate")


@query(
    "ab_group_moments",
    f"""
WITH {_SAMPLE}
SELECT side, count(*) AS n, CAST(round(CAST(avg(x) AS DECIMAL(18,6)), 4) AS DOUBLE) AS mean,
       CAST(round(CAST(var_samp(x) AS DECIMAL(18,6)), 4) AS DOUBLE) AS variance FROM sample GROUP BY side""",
    _SAMPLE_ROLES,
)
def _ab_moments(spark, sf_dir):
    moments = samples.group_moments(_revenue_sample(spark, sf_dir))
    return moments.select("side", "n", *[F.round(F.col(c).cast("decimal(18,6)"), 4).alias(c) for c in ("mean", "variance")])


@query(
    "ab_spread_moments",
    f"""
WITH {_SAMPLE}, centred AS (SELECT side, abs(x - avg(x) OVER (PARTITION BY side)) AS d FROM sample)
SELECT side, count(*) AS n, CAST(round(CAST(avg(d) AS DECIMAL(18,6)), 4) AS DOUBLE) AS mean,
       CAST(round(CAST(var_samp(d) AS DECIMAL(18,6)), 4) AS DOUBLE) AS variance FROM centred GROUP BY side""",
    _SAMPLE_ROLES,
)
def _ab_spread(spark, sf_dir):
    sample = _revenue_sample(spark, sf_dir)
    means = {side: m.mean for side, m in samples.collect_moments(sample).items()}
    moments = samples.group_moments(samples.deviations(sample, means))
    return moments.select("side", "n", *[F.round(F.col(c).cast("decimal(18,6)"), 4).alias(c) for c in ("mean", "variance")])


@query(
    "ab_rank_sums",
    f"""
WITH {_SAMPLE},
ranked AS (SELECT side, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS r FROM sample),
tied AS (SELECT sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM (SELECT count(*) AS t FROM sample GROUP BY x))
SELECT count(*) FILTER (side = 'control') AS n1, count(*) FILTER (side = 'test') AS n2,
       sum(r) FILTER (side = 'control') - count(*) FILTER (side = 'control') * (count(*) FILTER (side = 'control') + 1) / 2 AS u1,
       any_value(tied.ties) AS ties
FROM ranked, tied""",
    _SAMPLE_ROLES,
)
def _ab_rank_sums(spark, sf_dir):
    return samples.rank_sums(_revenue_sample(spark, sf_dir), "control", "test")


_COMPARED = f"""
WITH {EDA},
rev AS (SELECT s.day, sum(p.usd_event) FILTER (s.side = 'control') AS control, sum(p.usd_event) FILTER (s.side = 'test') AS test
        FROM trial s JOIN spending p ON p.session_id = s.session_id WHERE p.usd_event IS NOT NULL AND s.side IS NOT NULL GROUP BY ALL),
acc AS (SELECT day, count(DISTINCT account_id) FILTER (side = 'control') AS c, count(DISTINCT account_id) FILTER (side = 'test') AS t FROM trial GROUP BY ALL),
sample AS (
  SELECT 'ARPDAU (daily)' AS metric, 'control' AS side, CAST(rev.control AS DOUBLE) / NULLIF(acc.c, 0) AS x FROM acc JOIN rev ON rev.day = acc.day
  UNION ALL SELECT 'ARPDAU (daily)', 'test', CAST(rev.test AS DOUBLE) / NULLIF(acc.t, 0) FROM acc JOIN rev ON rev.day = acc.day
  UNION ALL SELECT 'Total Revenue / Account (all users)', group_type, total_revenue FROM eda
  UNION ALL SELECT 'Total Revenue / Account (converters)', group_type, total_revenue FROM eda WHERE converted
  UNION ALL SELECT 'Purchase Count / Account (all users)', group_type, CAST(purchase_count AS DOUBLE) FROM eda
  UNION ALL SELECT 'Purchase Count / Account (converters)', group_type, CAST(purchase_count AS DOUBLE) FROM eda WHERE converted),
centred AS (SELECT metric, side, x, x - avg(x) OVER (PARTITION BY metric, side) AS e FROM sample WHERE x IS NOT NULL),
m AS (SELECT metric, side, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mean, var_samp(x) AS v, avg(abs(e)) AS dm, var_samp(abs(e)) AS dv,
             sqrt(count(*)) * sum(e * e * e) / nullif(pow(sum(e * e), 1.5), 0) AS skew,
             count(*) * sum(e * e * e * e) / nullif(pow(sum(e * e), 2), 0) - 3 AS kurt FROM centred GROUP BY ALL),
normal AS (SELECT *, coalesce(exp(-(n / 6) * (skew * skew + kurt * kurt / 4) / 2), 1) AS jb FROM m),
ranked AS (SELECT metric, side, rank() OVER (PARTITION BY metric ORDER BY x) + (count(*) OVER (PARTITION BY metric, x) - 1) / 2 AS r FROM centred),
us AS (SELECT metric, sum(r) - count(*) * (count(*) + 1) / 2 AS u FROM ranked WHERE side = 'control' GROUP BY metric),
pairs AS (
  SELECT a.metric, a.jb AS ja, b.jb AS jb, a.n AS na, b.n AS nb, a.mean AS ma, b.mean AS mb, a.v AS va, b.v AS vb, a.dm AS da, b.dm AS db,
         a.dv AS sa, b.dv AS sb, (a.n * a.dm + b.n * b.dm) / (a.n + b.n) AS grand, u
  FROM normal a JOIN normal b ON a.metric = b.metric JOIN us ON us.metric = a.metric WHERE a.side = 'control' AND b.side = 'test'),
rates AS (
  SELECT CAST(count(*) FILTER (group_type = 'control' AND converted) AS DOUBLE) AS x1, CAST(count(*) FILTER (group_type = 'control') AS DOUBLE) AS n1,
         CAST(count(*) FILTER (group_type = 'test' AND converted) AS DOUBLE) AS x2, CAST(count(*) FILTER (group_type = 'test') AS DOUBLE) AS n2 FROM eda),
shares AS (SELECT *, x1 / n1 AS p1, x2 / n2 AS p2, (x1 + x2) / (n1 + n2) AS p,
                  1.959963984540054 * sqrt(x1 / n1 * (1 - x1 / n1) / n1 + x2 / n2 * (1 - x2 / n2) / n2) AS half FROM rates)"""


@query(
    "ab_test_statistics",
    f"""
{_COMPARED}
SELECT metric, round(ja, 6) AS normality_control, round(jb, 6) AS normality_test,
       round((na + nb - 2) * (na * pow(da - grand, 2) + nb * pow(db - grand, 2)) / nullif((na - 1) * sa + (nb - 1) * sb, 0), 6) AS levene_w,
       round((ma - mb) / sqrt(nullif(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb), 0)), 6) AS student_t,
       round((ma - mb) / sqrt(nullif(va / na + vb / nb, 0)), 6) AS welch_t, u AS u_control,
       CAST(NULL AS DOUBLE) AS z, CAST(NULL AS DOUBLE) AS chi2, CAST(NULL AS DOUBLE) AS ci_low, CAST(NULL AS DOUBLE) AS ci_high FROM pairs
UNION ALL
SELECT 'Conversion Rate', NULL, NULL, NULL, NULL, NULL, NULL,
       round((p1 - p2) / nullif(sqrt(p * (1 - p) * (1 / n1 + 1 / n2)), 0), 6),
       round((n1 + n2) * pow(greatest(0, abs(x1 * (n2 - x2) - x2 * (n1 - x1)) - (n1 + n2) / 2), 2) / nullif((x1 + x2) * (n1 + n2 - x1 - x2) * n1 * n2, 0), 6),
       round(p2 - p1 - half, 6), round(p2 - p1 + half, 6) FROM shares""",
    ACCOUNT_ROLES,
)
def _ab_statistics(spark, sf_dir):
    return build_statistics(*_experiment(spark, sf_dir)).select("metric", *[F.round(name, 6).alias(name) for name in STATISTICS])


# Steps of Simpson's rule, by which SQL finds two-sided tails: of the normal, and of Student's t over atan(t / sqrt(dof)).
# The upper tail of F with one and n degrees of freedom is that of t at its root, that of chi-square with one the normal's.
_STEPS = 4000


@query(
    "ab_test_report",
    f"""
{_COMPARED},
tied AS (SELECT metric, sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM (SELECT metric, x, count(*) AS t FROM centred GROUP BY ALL) GROUP BY metric),
found AS (
  SELECT pairs.metric, ja, jb, u, na + nb - 2 AS dof,
         (na + nb - 2) * (na * pow(da - grand, 2) + nb * pow(db - grand, 2)) / nullif((na - 1) * sa + (nb - 1) * sb, 0) AS levene,
         (ma - mb) / sqrt(nullif(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb), 0)) AS student,
         (ma - mb) / sqrt(nullif(va / na + vb / nb, 0)) AS welch,
         pow(va / na + vb / nb, 2) / nullif(pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1), 0) AS welch_dof,
         (greatest(u, na * nb - u) - na * nb / 2 - 0.5) / sqrt(nullif(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1))), 0)) AS z
  FROM pairs JOIN tied ON tied.metric = pairs.metric),
share AS (
  SELECT (p1 - p2) / nullif(sqrt(p * (1 - p) * (1 / n1 + 1 / n2)), 0) AS z, p2 - p1 - half AS low, p2 - p1 + half AS high,
         (n1 + n2) * pow(greatest(0, abs(x1 * (n2 - x2) - x2 * (n1 - x1)) - (n1 + n2) / 2), 2) / nullif((x1 + x2) * (n1 + n2 - x1 - x2) * n1 * n2, 0) AS chi2
  FROM shares),
asked AS (
  SELECT metric, 'levene' AS test, sqrt(levene) AS x, dof FROM found
  UNION ALL SELECT metric, 'student_t', abs(student), dof FROM found
  UNION ALL SELECT metric, 'welch_t', abs(welch), welch_dof FROM found
  UNION ALL SELECT metric, 'mann_whitney', CASE WHEN z > 0 THEN z WHEN z <= 0 THEN 0 END, NULL FROM found
  UNION ALL SELECT 'Conversion Rate', 'prop_z', abs(z), NULL FROM share
  UNION ALL SELECT 'Conversion Rate', 'chi2', sqrt(chi2), NULL FROM share),
steps AS (SELECT i, CASE WHEN i IN (0, {_STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight FROM range(0, {_STEPS} + 1) AS r(i)),
middles AS (
  SELECT metric, test,
         CASE WHEN dof IS NULL THEN sqrt(2 / pi()) * x * sum(weight * exp(-pow(x * i / {_STEPS}, 2) / 2))
              ELSE 2 / sqrt(pi()) * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) * atan(x / sqrt(dof))
                   * sum(weight * pow(cos(atan(x / sqrt(dof)) * i / {_STEPS}), dof - 1)) END / (3 * {_STEPS}) AS middle
  FROM asked, steps GROUP BY metric, test, x, dof),
tails AS (SELECT metric, test, CASE WHEN middle > 1 THEN 0 ELSE 1 - middle END AS p FROM middles),
chosen AS (
  SELECT found.*, CASE WHEN ja <= 0.05 OR jb <= 0.05 THEN 'mann_whitney' WHEN p > 0.05 THEN 'student_t' ELSE 'welch_t' END AS test_used
  FROM found JOIN tails ON tails.metric = found.metric AND test = 'levene')
SELECT chosen.metric, 'continuous' AS domain, test_used,
       CASE test_used WHEN 'student_t' THEN 'parametric: Student t (equal var)' WHEN 'welch_t' THEN 'parametric: Welch t (unequal var)'
                      ELSE 'nonparametric: Mann–Whitney U' END AS basis,
       round(CASE test_used WHEN 'student_t' THEN student WHEN 'welch_t' THEN welch ELSE u END, 6) AS statistic, round(p, 6) AS p_value,
       CAST(0.05 AS DOUBLE) AS alpha, CASE WHEN p < 0.05 THEN 'Reject H0' ELSE 'Fail to reject H0' END AS decision,
       CAST(NULL AS VARCHAR) AS ci_compare, CAST(NULL AS VARCHAR) AS ci_method, CAST(NULL AS DOUBLE) AS ci_low, CAST(NULL AS DOUBLE) AS ci_high,
       CAST(NULL AS DOUBLE) AS chi2_stat, CAST(NULL AS DOUBLE) AS chi2_p_value, CAST(NULL AS INTEGER) AS chi2_dof
FROM chosen JOIN tails ON tails.metric = chosen.metric AND tails.test = test_used
UNION ALL
SELECT 'Conversion Rate', 'proportion', 'two_proportion_z', 'z + chi2', round(z, 6), round(a.p, 6), 0.05,
       CASE WHEN a.p < 0.05 THEN 'Reject H0' ELSE 'Fail to reject H0' END, 'diff', 'wald', round(low, 6), round(high, 6), round(chi2, 6), round(b.p, 6), 1
FROM share, tails a, tails b WHERE a.test = 'prop_z' AND b.test = 'chi2'""",
    ACCOUNT_ROLES,
)
def _ab_report(spark, sf_dir):
    report = build_report(*_experiment(spark, sf_dir))
    doubles = [f.name for f in report.schema if f.dataType.typeName() == "double" and f.name != "alpha"]
    return report.withColumns({c: F.when(~F.isnan(c), F.round(c, 6)) for c in doubles})
