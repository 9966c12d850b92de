"""The marts and series over bronze roles of the star tables, each with the SQL it must agree with."""

from __future__ import annotations

import uuid
from types import SimpleNamespace

from questmart.functions.catalog import SERIES_OFFERS
from questmart.operators.cohorts import DAY_OFFSETS
from questmart.params import Params
from questmart.plans import analytics, gold, series, silver
from questmart.sources.bronze import load_bronze
from questmart.sources.star_tables import bronze_from_star
from verification.registry import query
from verification.sql_parts import SPENDING, exact_ratio, percent, ratio, text

P = Params()

# ---------------------------------------------------------------- silver

METRICS_SQL = f"""
WITH {SPENDING},
s AS (SELECT *, CAST(session_start AS DATE) AS session_day FROM sessions),
firsts AS (SELECT account_id, min(session_day) AS first_day, max(session_day) AS last_day FROM s GROUP BY account_id),
base AS (
    SELECT s.session_day, strftime(s.session_day, '%a') AS day_of_week, count(*) AS total_sessions,
           count(DISTINCT s.account_id) AS unique_players,
           count(DISTINCT CASE WHEN s.session_day = f.first_day THEN s.account_id END) AS new_accounts,
           count(DISTINCT CASE WHEN s.session_day = f.last_day THEN s.account_id END) AS churned_accounts,
           count(DISTINCT CASE WHEN s.session_day = f.last_day AND s.session_day = f.first_day THEN s.account_id END) AS stopover_accounts,
           count(DISTINCT CASE WHEN s.platform = 'iOS' THEN s.account_id END) AS ios_unique_accounts,
           count(DISTINCT CASE WHEN s.platform = 'Android' THEN s.account_id END) AS android_unique_accounts,
           count(*) FILTER (s.platform = 'iOS') AS ios_count, count(*) FILTER (s.platform = 'Android') AS android_count,
           sum(s.duration_seconds) AS duration, count(s.duration_seconds) AS timed, sum(hour(s.session_start)) AS hours,
           quantile_disc(CAST(s.duration_seconds AS DOUBLE), 0.10) AS p10_ses_dur,
           quantile_disc(CAST(s.duration_seconds AS DOUBLE), 0.25) AS p25_ses_dur,
           median(s.duration_seconds) AS mdn_ses_dur,
           quantile_disc(CAST(s.duration_seconds AS DOUBLE), 0.75) AS p75_ses_dur,
           quantile_disc(CAST(s.duration_seconds AS DOUBLE), 0.90) AS p90_ses_dur,
           mode() WITHIN GROUP (ORDER BY s.device_model) AS most_common_device,
           mode() WITHIN GROUP (ORDER BY s.end_reason) AS most_common_end_reason
    FROM s LEFT JOIN firsts f ON f.account_id = s.account_id GROUP BY ALL),
peaks AS (
    SELECT session_day, hr AS peak_hour_of_day
    FROM (SELECT session_day, hour(session_start) AS hr, count(*) AS n FROM s GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY session_day ORDER BY n DESC, hr) = 1),
paid AS (SELECT day, sum(usd) AS rev, count(DISTINCT account_id) AS buyers, count(*) AS n FROM spending GROUP BY day),
adrev AS (SELECT CAST(interaction_time AS DATE) AS day, round(sum(CAST(revenue AS DECIMAL(18,6))), 3) AS rev
          FROM hosted_ad_interactions GROUP BY ALL),
acts AS (
    SELECT s.session_day,
           count(DISTINCT s.session_id) FILTER (e.event_type = 'business') AS sessions_with_purchase,
           count(DISTINCT s.session_id) FILTER (e.event_type = 'ad') AS sessions_with_ads,
           count(DISTINCT e.account_id) FILTER (e.event_type = 'ad') AS adview_unique_accounts,
           count(e.account_id) FILTER (e.event_type = 'ad') AS total_ad_events
    FROM s LEFT JOIN (SELECT * FROM events_role WHERE event_type = 'business'
                      OR (event_type = 'ad' AND event_subtype IN ('ad_shown', 'reward_ad_shown'))) e
           ON e.session_id = s.session_id
    GROUP BY s.session_day)
SELECT {text('b.session_day')}, b.day_of_week, b.unique_players, b.new_accounts, b.churned_accounts, b.stopover_accounts,
       b.unique_players - b.new_accounts - b.churned_accounts + b.stopover_accounts AS retained_accounts,
       b.total_sessions, p.buyers AS purchasing_unique_accounts, a.sessions_with_purchase, p.n AS total_purchase_events,
       a.adview_unique_accounts, a.sessions_with_ads, a.total_ad_events,
       {percent('p.buyers', 'b.unique_players')} AS pct_accounts_with_purchase,
       {percent('a.adview_unique_accounts', 'b.unique_players')} AS pct_accounts_with_ad_view,
       {percent('a.sessions_with_purchase', 'b.total_sessions')} AS pct_sessions_with_purchase,
       {percent('a.sessions_with_ads', 'b.total_sessions')} AS pct_sessions_with_ad_view,
       {ratio('b.total_sessions', 'b.unique_players', 2)} AS avg_session_per_player,
       {ratio('b.duration', 'b.timed', 2)} AS avg_session_duration,
       {ratio('b.hours', 'b.total_sessions', 2)} AS avg_hour_of_day,
       k.peak_hour_of_day, b.p10_ses_dur, b.p25_ses_dur, b.mdn_ses_dur, b.p75_ses_dur, b.p90_ses_dur,
       b.ios_count, b.android_count, b.ios_unique_accounts, b.android_unique_accounts,
       {percent('b.ios_unique_accounts', 'b.unique_players')} AS pct_ios_users,
       {percent('b.android_unique_accounts', 'b.unique_players')} AS pct_android_users,
       b.most_common_device, b.most_common_end_reason,
       CAST(p.rev AS DOUBLE) AS total_purchase_rev, CAST(r.rev AS DOUBLE) AS total_ad_rev, CAST(p.rev + r.rev AS DOUBLE) AS total_rev,
       {ratio('p.rev', 'b.unique_players', 2)} AS arpu_purchase, {ratio('r.rev', 'b.unique_players', 3)} AS arpu_ads,
       {ratio('(p.rev + r.rev)', 'b.unique_players', 2)} AS arpu_total, {ratio('p.rev', 'p.buyers', 2)} AS arppu,
       {ratio('p.rev', 'b.total_sessions', 2)} AS avg_purc_rev_per_ses,
       {ratio('r.rev', 'b.total_sessions', 3)} AS avg_ad_rev_per_ses,
       {ratio('(p.rev + r.rev)', 'b.total_sessions', 2)} AS avg_total_rev_per_ses
FROM base b LEFT JOIN paid p ON p.day = b.session_day LEFT JOIN adrev r ON r.day = b.session_day
     LEFT JOIN acts a ON a.session_day = b.session_day LEFT JOIN peaks k ON k.session_day = b.session_day"""

METRIC_ROLES = ("sessions", "events", "hosted_ad_interactions", "exchange_rate")


@query("session_metrics", METRICS_SQL, METRIC_ROLES)
def _session_metrics(spark, sf_dir):
    return silver.session_metrics(bronze_from_star(spark, sf_dir), P)


def _flow_json(item: str, direction: str) -> str:
    return f"""
    (SELECT account_id, '{{' || string_agg('"' || reason || '":' || total, ',' ORDER BY total DESC, reason) || '}}' AS doc
     FROM (SELECT account_id, reason, sum(amount) AS total FROM moves
           WHERE direction = '{direction}' AND item = '{item}' AND reason IS NOT NULL GROUP BY ALL HAVING sum(amount) > 0)
     GROUP BY account_id)"""


ACCOUNT_CTES = f"""
{SPENDING},
life AS (SELECT account_id, count(*) AS n, round(avg(duration_seconds)) AS d FROM sessions GROUP BY account_id),
lim AS (SELECT quantile_disc(CAST(n AS DOUBLE), 0.33) AS s33, quantile_disc(CAST(n AS DOUBLE), 0.66) AS s66,
               quantile_disc(CAST(d AS DOUBLE), 0.33) AS d33, quantile_disc(CAST(d AS DOUBLE), 0.66) AS d66 FROM life),
recent AS (
    SELECT w.*, CASE WHEN n <= s33 AND d <= d33 THEN 'casual'
                     WHEN (n > s33 AND n <= s66) OR (d > d33 AND d <= d66) THEN 'core'
                     WHEN n > s66 OR d > d66 THEN 'hardcore' ELSE 'unknown' END AS engagement,
           CASE WHEN TIMESTAMP '{P.churn_cutoff}' - wk >= INTERVAL 28 DAYS THEN 'churned'
                WHEN TIMESTAMP '{P.churn_cutoff}' - wk >= INTERVAL 14 DAYS THEN 'dormant' ELSE 'active' END AS churn
    FROM (SELECT account_id, CAST(date_trunc('week', session_start) AS TIMESTAMP) AS wk, count(*) AS n,
                 round(avg(duration_seconds)) AS d
          FROM sessions GROUP BY account_id, date_trunc('week', session_start)) w, lim
    QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY wk DESC) = 1),
totals AS (SELECT account_id, count(*) AS session_count, sum(duration_seconds) AS total_duration,
                  count(*) FILTER (end_reason <> 'player_exit') AS error_count FROM sessions GROUP BY account_id),
latest AS (SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY session_start DESC, session_id DESC) = 1),
adrev AS (SELECT account_id, sum(CAST(revenue AS DECIMAL(18,6))) AS rev FROM hosted_ad_interactions GROUP BY account_id),
buys AS (
    SELECT account_id, min(day) AS first_day, max(day) AS last_day, count(*) AS n, sum(usd) AS total,
           COALESCE(mode() WITHIN GROUP (ORDER BY offer_id), 'none') AS favourite,
           count(*) FILTER (offer_id LIKE '%subscription%') AS subs,
           max(day) FILTER (offer_id LIKE '%subscription%') AS last_sub
    FROM spending GROUP BY account_id),
levels AS (SELECT account_id, max(CAST(split_part(event_metadata ->> '$.level_id', '_', 2) AS INT)) AS lvl
           FROM events_role WHERE event_subtype = 'level_success' GROUP BY account_id),
moves AS (
    SELECT account_id, session_id, split_part(event_subtype, '_', 1) AS direction,
           CASE WHEN event_metadata ->> '$.item_id' LIKE '%gold' THEN 'gold'
                WHEN event_metadata ->> '$.item_id' LIKE '%diamond' THEN 'diamond' ELSE 'other' END AS item,
           CAST(event_metadata ->> '$.item_amount' AS INT) AS amount,
           CASE WHEN event_metadata ->> '$.reason' LIKE 'LEVEL_%' THEN 'level_progression'
                WHEN event_metadata ->> '$.reason' LIKE 'TUTORIAL_%' THEN 'tutorial_progression'
                ELSE event_metadata ->> '$.reason' END AS reason
    FROM events_role WHERE event_type = 'resource'),
flows AS (
    SELECT account_id, direction, count(*) FILTER (item = 'gold') AS gold_events,
           count(DISTINCT session_id) FILTER (item = 'gold') AS gold_sessions,
           sum(amount) FILTER (item = 'gold') AS gold, sum(amount) FILTER (item = 'diamond') AS diamond,
           mode() WITHIN GROUP (ORDER BY reason) FILTER (item = 'gold') AS gold_reason,
           mode() WITHIN GROUP (ORDER BY reason) FILTER (item = 'diamond') AS diamond_reason,
           count(*) FILTER (item = 'diamond') AS diamond_events,
           count(DISTINCT session_id) FILTER (item = 'diamond') AS diamond_sessions
    FROM moves GROUP BY ALL),
extended AS (
    SELECT t.account_id, t.session_count, t.total_duration, t.error_count, l.region AS current_country,
           l.platform AS current_platform, l.device_model AS current_device, l.os_version AS current_os,
           l.app_version AS current_app_version, l.session_start AS latest_session,
           EXISTS (SELECT 1 FROM sessions s WHERE s.account_id = t.account_id AND CAST(s.session_start AS DATE) > a.signup_date
                   AND CAST(s.session_start AS DATE) <= a.signup_date + INTERVAL 7 DAYS) AS retained_within_7_days,
           EXISTS (SELECT 1 FROM sessions s WHERE s.account_id = t.account_id AND CAST(s.session_start AS DATE) > a.signup_date + INTERVAL 7 DAYS
                   AND CAST(s.session_start AS DATE) <= a.signup_date + INTERVAL 30 DAYS) AS retained_within_30_days,
           a.username, a.email, a.email_is_anonymized, a.signup_date, a.referral_source, a.creation_method,
           COALESCE(a.acquisition_metadata ->> '$.search_query', 'N/A') AS search_query,
           COALESCE(a.acquisition_metadata ->> '$.ad_name', 'N/A') AS ad_name,
           COALESCE(a.acquisition_metadata ->> '$.campaign_name', 'N/A') AS campaign_name,
           COALESCE(a.acquisition_metadata ->> '$.search_ad_keyword', 'N/A') AS search_ad_keyword,
           COALESCE(a.acquisition_metadata ->> '$.referral_code', 'N/A') AS referral_code,
           COALESCE(a.acquisition_metadata ->> '$.referral_account_id', 'N/A') AS referral_account_id,
           CAST(COALESCE(r.rev, 0) AS DOUBLE) AS ad_rev, b.first_day AS first_purchase_date, b.last_day AS last_purchase_date,
           EXISTS (SELECT 1 FROM spending p WHERE p.account_id = t.account_id AND p.day >= a.signup_date
                   AND p.day <= a.signup_date + INTERVAL 7 DAYS) AS monetized_within_7_days,
           DATE '{P.end_date}' - b.last_day AS purchase_recency_days, b.n AS number_of_purchases, b.favourite AS most_purchased_item,
           CAST(b.total AS DOUBLE) AS total_purchase, COALESCE({ratio('b.total', 'b.n', 2)}, 0) AS avg_purchase_value,
           CAST(v.lvl AS BIGINT) AS last_completed_level,
           CASE WHEN a.referral_source IS NULL THEN 'direct'
                WHEN a.referral_source IN ('ad_fb', 'ad_gdn', 'ad_ig', 'ad_in_app', 'ad_tk', 'ad_x', 'ad_yt') THEN 'paid_social'
                WHEN a.referral_source = 'ad_search_engine' THEN 'paid_search' WHEN a.referral_source = 'friend_referral' THEN 'referral'
                WHEN a.referral_source = 'organic_search' THEN 'organic' ELSE 'unknown' END AS acquisition_segment,
           CASE WHEN b.total IS NULL OR b.total < 1 THEN 'minnow' WHEN b.total < 100 THEN 'dolphin'
                WHEN b.total < 500 THEN 'whale' ELSE 'kraken' END AS monetization_segment,
           w.engagement AS engagement_segment, w.churn AS churn_segment,
           CASE WHEN v.account_id IS NULL THEN NULL WHEN v.lvl = 100 THEN 'completed' WHEN v.lvl > 80 THEN 'endgame'
                WHEN v.lvl > 50 THEN 'late_stage' WHEN v.lvl > 20 THEN 'mid_stage' ELSE 'starter' END AS completion_segment,
           CASE WHEN b.last_sub + 30 >= DATE '{P.end_date}' THEN 'active' WHEN b.last_sub + 30 < DATE '{P.end_date}' THEN 'inactive'
                ELSE 'never' END AS subscription_status,
           b.subs AS subscription_purchases, CAST(COALESCE(b.total, 0) + COALESCE(r.rev, 0) AS DOUBLE) AS ltv,
           i.gold_events AS gold_source_event_count, i.gold_sessions AS gold_source_session_count,
           CAST(i.gold AS BIGINT) AS total_gold_earned, i.gold_reason AS top_gold_earn_reason,
           CAST(i.diamond AS BIGINT) AS total_diamond_earned, i.diamond_reason AS top_diamond_earn_reason,
           CAST(COALESCE(o.gold, 0) AS BIGINT) AS total_gold_spent, COALESCE(o.gold_reason, 'None') AS top_gold_spend_reason,
           CAST(COALESCE(o.diamond, 0) AS BIGINT) AS total_diamond_spent, COALESCE(o.diamond_reason, 'None') AS top_diamond_spend_reason,
           CAST(i.gold - COALESCE(o.gold, 0) AS BIGINT) AS current_gold, CAST(i.diamond - COALESCE(o.diamond, 0) AS BIGINT) AS current_diamond,
           COALESCE(gs.doc, '{{}}') AS gold_source_distribution, COALESCE(gk.doc, '{{}}') AS gold_sink_distribution,
           COALESCE(ds.doc, '{{}}') AS diamond_source_distribution, COALESCE(dk.doc, '{{}}') AS diamond_sink_distribution
    FROM totals t LEFT JOIN latest l ON l.account_id = t.account_id LEFT JOIN accounts a ON a.account_id = t.account_id
    LEFT JOIN adrev r ON r.account_id = t.account_id LEFT JOIN buys b ON b.account_id = t.account_id
    LEFT JOIN recent w ON w.account_id = t.account_id LEFT JOIN levels v ON v.account_id = t.account_id
    LEFT JOIN flows i ON i.account_id = t.account_id AND i.direction = 'source'
    LEFT JOIN flows o ON o.account_id = t.account_id AND o.direction = 'sink'
    LEFT JOIN {_flow_json('gold', 'source')} gs ON gs.account_id = t.account_id
    LEFT JOIN {_flow_json('gold', 'sink')} gk ON gk.account_id = t.account_id
    LEFT JOIN {_flow_json('diamond', 'source')} ds ON ds.account_id = t.account_id
    LEFT JOIN {_flow_json('diamond', 'sink')} dk ON dk.account_id = t.account_id)"""

ACCOUNT_ROLES = ("accounts", "sessions", "events", "hosted_ad_interactions", "exchange_rate")
EXTENDED_SQL = f"""
WITH {ACCOUNT_CTES}
SELECT * REPLACE (CAST(latest_session AS VARCHAR) AS latest_session, CAST(signup_date AS VARCHAR) AS signup_date,
                  CAST(first_purchase_date AS VARCHAR) AS first_purchase_date, CAST(last_purchase_date AS VARCHAR) AS last_purchase_date)
FROM extended"""


@query("accounts_extended", EXTENDED_SQL, ACCOUNT_ROLES)
def _accounts_extended(spark, sf_dir):
    return silver.accounts_extended(bronze_from_star(spark, sf_dir), P)


@query(
    "hosted_ads_act_detailed",
    f"""
SELECT i.interaction_id, i.ad_id, {text('i.interaction_time')}, i.interaction_type, i.revenue, i.platform, i.region, i.device_model,
       i.account_id, h.ad_network, h.pricing_model, h.value_per_action, {text('h.start_date')}, {text('h.end_date')}, h.is_active,
       h.advertised_product, CAST(h.ad_length AS BIGINT) AS ad_length, h.rewarded
FROM hosted_ad_interactions i LEFT JOIN hosted_ads h ON h.ad_id = i.ad_id""",
    ("hosted_ad_interactions", "hosted_ads"),
)
def _hosted_ads_act_detailed(spark, sf_dir):
    return silver.hosted_ads_act_detailed(bronze_from_star(spark, sf_dir), P)


# ---------------------------------------------------------------- gold

ACQUISITION = """
acquired AS (
    SELECT CAST(signup_date AS DATE) AS date, referral_source, acquisition_metadata ->> '$.campaign_name' AS campaign_name,
           acquisition_metadata ->> '$.ad_name' AS ad_name, acquisition_metadata ->> '$.search_ad_keyword' AS search_ad_keyword,
           count(*) AS daily_acquired_users
    FROM accounts GROUP BY ALL)"""


@query("acquisition_daily", f"WITH {ACQUISITION} SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM acquired", ("accounts",))
def _acquisition_daily(spark, sf_dir):
    return gold.acquisition_daily(bronze_from_star(spark, sf_dir), P)


def _grain(table: str, keys: str, grain: str, period: str | None, kinds: dict[str, str]) -> str:
    counts = ", ".join(f"count(DISTINCT {column}) AS {grain}_{kind}" for kind, column in kinds.items())
    start = f", CAST(date_trunc('{period}', day) AS DATE) AS start" if period else ""
    return f"{grain} AS (SELECT {keys}{start}, {counts} FROM {table} GROUP BY ALL)"


_BIZ = {"buyers": "account_id", "sessions": "session_id"}
OFFERS = f"""
{SPENDING},
{_grain('spending', 'offer_id, reward_category', 'weekly', 'week', _BIZ)},
{_grain('spending', 'offer_id, reward_category', 'monthly', 'month', _BIZ)},
{_grain('spending', 'offer_id, reward_category', 'total', None, _BIZ)},
daily AS (SELECT offer_id, reward_category, day, count(*) AS n, count(DISTINCT account_id) AS buyers,
                 count(DISTINCT session_id) AS sessions, sum(usd) AS revenue FROM spending GROUP BY ALL),
offers AS (
    SELECT d.offer_id, d.day AS event_date, d.reward_category, d.n AS purchase_count, d.sessions AS daily_purchase_sessions,
           d.buyers AS daily_unique_buyers, COALESCE(w.weekly_buyers, 0) AS weekly_unique_buyers,
           COALESCE(w.weekly_sessions, 0) AS weekly_purchase_sessions, COALESCE(m.monthly_buyers, 0) AS monthly_unique_buyers,
           COALESCE(m.monthly_sessions, 0) AS monthly_purchase_sessions, COALESCE(o.total_buyers, 0) AS total_unique_buyers,
           COALESCE(o.total_sessions, 0) AS total_purchase_sessions, CAST(d.revenue AS DOUBLE) AS total_revenue,
           {ratio('d.revenue', 'd.sessions', 2)} AS avg_revenue_per_purchasing_sessions,
           {ratio('d.revenue', 'd.buyers', 2)} AS avg_revenue_per_buyer
    FROM daily d
    LEFT JOIN weekly w ON w.offer_id = d.offer_id AND w.reward_category = d.reward_category AND w.start = date_trunc('week', d.day)
    LEFT JOIN monthly m ON m.offer_id = d.offer_id AND m.reward_category = d.reward_category AND m.start = date_trunc('month', d.day)
    LEFT JOIN total o ON o.offer_id = d.offer_id AND o.reward_category = d.reward_category)"""


@query(
    "biz_offer_performance",
    f"WITH {OFFERS} SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM offers",
    ("events", "exchange_rate"),
)
def _biz_offer_performance(spark, sf_dir):
    return gold.biz_offer_performance(bronze_from_star(spark, sf_dir), P)


_SHOP = {"sessions": "session_id", "shoppers": "account_id"}


@query(
    "shop_offer_performance",
    f"""
WITH sinks AS (
    SELECT event_metadata ->> '$.reason' AS offer_id, split_part(event_metadata ->> '$.item_id', '_', 2) AS currency_type,
           CAST(event_date AS DATE) AS day, session_id, account_id, CAST(event_metadata ->> '$.item_amount' AS DECIMAL(18,3)) AS amount
    FROM events_role WHERE event_subtype = 'sink_item' AND event_metadata ->> '$.item_category' = 'currency'),
{_grain('sinks', 'offer_id, currency_type', 'weekly', 'week', _SHOP)},
{_grain('sinks', 'offer_id, currency_type', 'monthly', 'month', _SHOP)},
{_grain('sinks', 'offer_id, currency_type', 'total', None, _SHOP)},
daily AS (SELECT offer_id, currency_type, day, count(*) AS n, count(DISTINCT session_id) AS sessions,
                 count(DISTINCT account_id) AS shoppers, sum(amount) AS spent FROM sinks GROUP BY ALL)
SELECT d.offer_id, d.currency_type, {text('d.day', 'event_date')}, d.n AS daily_purchase_count, d.sessions AS daily_shop_sessions,
       d.shoppers AS daily_unique_shoppers, CAST(d.spent AS DOUBLE) AS total_currency_spent,
       {ratio('d.spent', 'd.sessions', 2)} AS avg_sink_per_session, {ratio('d.spent', 'd.shoppers', 2)} AS avg_sink_per_shopper,
       w.weekly_sessions AS weekly_shop_sessions, w.weekly_shoppers AS weekly_unique_shoppers,
       m.monthly_sessions AS monthly_shop_sessions, m.monthly_shoppers AS monthly_unique_shoppers,
       o.total_sessions AS total_shop_sessions, o.total_shoppers AS total_unique_shoppers
FROM daily d
LEFT JOIN weekly w ON w.offer_id = d.offer_id AND w.currency_type = d.currency_type AND w.start = date_trunc('week', d.day)
LEFT JOIN monthly m ON m.offer_id = d.offer_id AND m.currency_type = d.currency_type AND m.start = date_trunc('month', d.day)
LEFT JOIN total o ON o.offer_id = d.offer_id AND o.currency_type = d.currency_type""",
    ("events",),
)
def _shop_offer_performance(spark, sf_dir):
    return gold.shop_offer_performance(bronze_from_star(spark, sf_dir), P)


_COHORT = ", ".join(gold.COHORT_KEYS)
_LATER = DAY_OFFSETS[1:]


@query(
    "cohort_churn",
    f"""
WITH {ACCOUNT_CTES},
members AS (SELECT account_id, CAST(signup_date AS DATE) AS signup_day, {_COHORT.split(', ', 1)[1]} FROM extended),
active AS (SELECT DISTINCT account_id, CAST(session_start AS DATE) AS day FROM sessions),
counted AS (
    SELECT {', '.join('c.' + k for k in gold.COHORT_KEYS)},
           {', '.join(f"CASE WHEN c.signup_day + {n} <= (SELECT max(day) FROM active) THEN count(*) FILTER (x.day - c.signup_day = {n}) END AS r{n}" for n in DAY_OFFSETS)}
    FROM members c LEFT JOIN active x ON x.account_id = c.account_id GROUP BY {', '.join('c.' + k for k in gold.COHORT_KEYS)})
SELECT * EXCLUDE (signup_day, {', '.join(f'r{n}' for n in DAY_OFFSETS)}), {text('signup_day')}, r0 AS day_0,
       {', '.join(f'r{n} AS day_{n}_return, r0 - r{n} AS day_{n}_churn' for n in _LATER)},
       {', '.join(f"{percent(f'r{n}', 'r0')} AS retention_rate_day{n}, {percent(f'(r0 - r{n})', 'r0')} AS churn_rate_day{n}" for n in _LATER)}
FROM counted""",
    ACCOUNT_ROLES,
)
def _cohort_churn(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return gold.cohort_churn(t, silver.accounts_extended(t, P), P)


@query(
    "hosted_ad_metrics",
    f"""
WITH acts AS (SELECT ad_id, interaction_type, count(*) AS n FROM hosted_ad_interactions GROUP BY ALL),
views AS (SELECT event_metadata ->> '$.ad_id' AS ad_id, count(*) AS n FROM events_role
          WHERE event_subtype IN ('ad_shown', 'reward_ad_shown') GROUP BY ALL),
priced AS (
    SELECT h.*, a.n AS acts, a.interaction_type AS kind, v.n AS views,
           round(CAST(CASE WHEN h.pricing_model = 'CPM' THEN h.value_per_action / 1000 ELSE h.value_per_action END * a.n AS DECIMAL(18,6)), 2) AS revenue
    FROM hosted_ads h LEFT JOIN acts a ON a.ad_id = h.ad_id LEFT JOIN views v ON v.ad_id = h.ad_id)
SELECT ad_id, ad_network, pricing_model, value_per_action, {text('start_date')}, {text('end_date')}, is_active, advertised_product,
       CAST(ad_length AS BIGINT) AS ad_length, rewarded, acts AS interaction_count, views AS view_count,
       CASE WHEN acts IS NOT NULL THEN CASE WHEN kind = 'click' THEN acts ELSE 0 END END AS click_count,
       CASE WHEN acts IS NOT NULL THEN CASE WHEN kind = 'install' THEN acts ELSE 0 END END AS install_count,
       CASE WHEN acts IS NOT NULL THEN CASE WHEN kind = 'action' THEN acts ELSE 0 END END AS action_count,
       CAST(revenue AS DOUBLE) AS total_revenue, NULLIF({percent('acts', 'views')}, 100) AS engagement_rate,
       {ratio('(CAST(revenue AS DOUBLE) * 1000)', 'views', 2)} AS ecpm
FROM priced""",
    ("hosted_ads", "hosted_ad_interactions", "events"),
)
def _hosted_ad_metrics(spark, sf_dir):
    return gold.hosted_ad_metrics(bronze_from_star(spark, sf_dir), P)


@query(
    "level_progression",
    f"""
WITH tries AS (
    SELECT account_id, event_metadata ->> '$.level_id' AS level_id, count(*) FILTER (event_subtype = 'level_start') AS s,
           count(*) FILTER (event_subtype = 'level_fail') AS f, count(*) FILTER (event_subtype = 'level_success') AS w
    FROM events_role WHERE event_type = 'progression' AND event_metadata ->> '$.level_id' NOT LIKE '%TUTORIAL%' GROUP BY ALL),
lv AS (SELECT level_id, sum(s) AS s, sum(f) AS f, sum(w) AS w, sum(f) FILTER (w > 0) AS fixed, count(account_id) AS n FROM tries GROUP BY ALL)
SELECT level_id, CAST(s AS BIGINT) AS attempt_count, CAST(w AS BIGINT) AS success_count, CAST(f AS BIGINT) AS fail_count,
       CAST(fixed AS BIGINT) AS resolved_fail_count, CAST(f - fixed AS BIGINT) AS leavers, CAST(s - w - f AS BIGINT) AS error_count,
       {percent('w', 's')} AS completion_rate, {percent('f', 's')} AS fail_pct, {ratio('(s - w - f)', 's', 3)} AS error_pct,
       {percent('fixed', 's')} AS resolved_fail_pct, {ratio('fixed', 'n', 2)} AS avg_fail
FROM lv""",
    ("events",),
)
def _level_progression(spark, sf_dir):
    return gold.level_progression(bronze_from_star(spark, sf_dir), P)


MARKETING = f"""
{SPENDING},
gained AS (SELECT account_id, email_is_anonymized, acquisition_metadata ->> '$.ad_name' AS ad_name FROM accounts
           WHERE acquisition_metadata ->> '$.ad_name' IS NOT NULL),
sign AS (SELECT ad_name, count(*) AS n, sum(CASE WHEN NOT email_is_anonymized THEN 1 END) AS ok FROM gained GROUP BY ALL),
rev AS (SELECT ad_name, sum(usd_exact) AS total FROM gained JOIN spending USING (account_id) GROUP BY ALL),
linked AS (
    SELECT a.*, c.campaign_name, c.campaign_type,
           CAST(cost_per_interaction * CASE c.campaign_type WHEN 'CPM' THEN impression_count / 1000 WHEN 'CPC' THEN click_count
                WHEN 'CPI' THEN install_count WHEN 'CPA' THEN action_count END AS DECIMAL(18,6)) AS spend
    FROM ads a LEFT JOIN ad_campaign_map m ON m.ad_id = a.ad_id LEFT JOIN campaigns c ON c.campaign_id = m.campaign_id),
ad_rows AS (
    SELECT l.campaign_name, l.ad_name, l.campaign_type, CAST(l.impression_count AS BIGINT) AS impression_count,
           CAST(l.click_count AS BIGINT) AS click_count, CAST(l.install_count AS BIGINT) AS install_count, s.n AS signup_count,
           CAST(l.action_count AS BIGINT) AS action_count, CAST(l.spend AS DOUBLE) AS spend, CAST(round(r.total, 2) AS DOUBLE) AS revenue,
           {percent('l.click_count', 'l.impression_count')} AS ctr, {percent('l.install_count', 'l.click_count')} AS cvr,
           {percent('l.install_count', 'l.impression_count')} AS ir, {ratio('l.spend', 'l.install_count', 2)} AS ecpi,
           {ratio('(l.spend * 1000)', 'l.impression_count', 2)} AS ecpm, {ratio('l.spend', 's.n', 2)} AS cpa,
           {ratio('r.total', 'l.spend', 2)} AS roas,
           CASE WHEN l.campaign_type = 'CPA' THEN {percent('s.ok', 's.n')} END AS acr
    FROM linked l LEFT JOIN sign s ON s.ad_name = l.ad_name LEFT JOIN rev r ON r.ad_name = l.ad_name)"""
MARKETING_ROLES = ("accounts", "events", "ads", "ad_campaign_map", "campaigns", "exchange_rate")


@query("marketing_ad_metrics", f"WITH {MARKETING} SELECT * FROM ad_rows", MARKETING_ROLES)
def _marketing_ad_metrics(spark, sf_dir):
    return gold.marketing_ad_metrics(bronze_from_star(spark, sf_dir), P)


# ---------------------------------------------------------------- analytics

@query(
    "ab_test_daily_accounts",
    f"""
SELECT CAST(CAST(session_start AS DATE) AS VARCHAR) AS session_date,
       count(*) FILTER (app_version = '{P.control_version}') AS control_session_count,
       count(DISTINCT account_id) FILTER (app_version = '{P.control_version}') AS control_unique_accounts,
       count(*) FILTER (app_version = '{P.test_version}') AS test_session_count,
       count(DISTINCT account_id) FILTER (app_version = '{P.test_version}') AS test_unique_accounts
FROM sessions WHERE session_start >= TIMESTAMP '{P.ab_start} 00:00:00' GROUP BY ALL""",
    ("sessions",),
)
def _ab_test_daily_accounts(spark, sf_dir):
    return analytics.ab_test_daily_accounts(bronze_from_star(spark, sf_dir), P)


_TRIAL = f"""
trial AS (SELECT *, CAST(session_start AS DATE) AS day, CASE app_version WHEN '{P.test_version}' THEN 'test' WHEN '{P.control_version}' THEN 'control' END AS side
          FROM sessions WHERE session_start >= TIMESTAMP '{P.ab_start} 00:00:00')"""


@query(
    "ab_test_daily_revenue",
    f"""
WITH {ACCOUNT_CTES}, {_TRIAL}
SELECT s.side AS group_type, s.account_id, s.session_id, x.acquisition_segment, {text('s.day', 'session_date')}, p.offer_id,
       CAST(p.usd_event AS DOUBLE) AS cost_usd,
       CAST(sum(p.usd_event) OVER (PARTITION BY s.side ORDER BY s.day) AS DOUBLE) AS cumulative_revenue
FROM trial s JOIN spending p ON p.session_id = s.session_id LEFT JOIN extended x ON x.account_id = s.account_id
WHERE s.side IS NOT NULL AND p.usd_event IS NOT NULL""",
    ACCOUNT_ROLES,
)
def _ab_test_daily_revenue(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return analytics.ab_test_daily_revenue(t, silver.accounts_extended(t, P), P)


EDA = f"""
{ACCOUNT_CTES}, {_TRIAL},
outcome AS (
    SELECT s.account_id, s.side, count(DISTINCT s.session_id) AS n, count(p.offer_id) AS buys, sum(p.usd_event) AS rev
    FROM trial s LEFT JOIN spending p ON p.session_id = s.session_id WHERE s.side IS NOT NULL GROUP BY ALL),
eda AS (
    SELECT o.account_id, o.side AS group_type, x.acquisition_segment, x.current_country, o.n AS session_count, o.rev IS NOT NULL AS converted,
           o.buys AS purchase_count, CAST(COALESCE(o.rev, 0) AS DOUBLE) AS total_revenue,
           COALESCE({ratio('o.rev', 'o.n', 2)}, 0) AS avg_rev_per_ses, COALESCE({ratio('o.rev', 'o.buys', 2)}, 0) AS avg_rev_per_purc
    FROM outcome o LEFT JOIN extended x ON x.account_id = o.account_id)"""


@query("ab_test_eda", f"WITH {EDA} SELECT * FROM eda", ACCOUNT_ROLES)
def _ab_test_eda(spark, sf_dir):
    t = bronze_from_star(spark, sf_dir)
    return analytics.ab_test_eda(t, silver.accounts_extended(t, P), P)


@query("ab_test_eda_from_day_folders", f"WITH {EDA} SELECT * FROM eda", ACCOUNT_ROLES)
def _ab_test_eda_from_day_folders(spark, sf_dir):
    """The same mart over facts that the bronze load stored by day."""
    star, database = bronze_from_star(spark, sf_dir), f"days_{uuid.uuid4().hex}"
    load_bronze(spark, {"sessions": star.sessions, "events": star.events}, database)
    t = SimpleNamespace(sessions=spark.table(f"{database}.sessions"), events=spark.table(f"{database}.events"))
    return analytics.ab_test_eda(t, silver.accounts_extended(star, P), P)


EQUIPMENT = """
stepped AS (
    SELECT *, lead(event_subtype) OVER w AS next_subtype, lead(event_metadata) OVER w AS next_doc
    FROM events_role WINDOW w AS (PARTITION BY account_id, session_id ORDER BY event_date, event_id, event_subtype, event_metadata)),
equipment AS (
    SELECT event_date, event_metadata ->> '$.level_id' AS level_id, event_metadata ->> '$.equipped_hero' AS equipped_hero,
           event_metadata ->> '$.equipped_skin' AS equipped_skin, event_metadata ->> '$.equipped_weapon' AS equipped_weapon,
           event_metadata ->> '$.equipped_armor' AS equipped_armor, event_metadata ->> '$.equipped_held_item' AS equipped_held_item,
           CASE next_subtype WHEN 'level_success' THEN true WHEN 'level_fail' THEN false END AS is_attempt_successful,
           next_doc ->> '$.total_score' AS total_score, COALESCE(next_doc ->> '$.stars_gained', '0') AS stars_gained
    FROM stepped WHERE event_subtype = 'level_start')"""


@query(
    "equipment_contribution_eda",
    f"WITH {EQUIPMENT} SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM equipment",
    ("events",),
)
def _equipment_contribution_eda(spark, sf_dir):
    return analytics.equipment_contribution_eda(bronze_from_star(spark, sf_dir), P)


# ---------------------------------------------------------------- series

@query("series_daily_revenue", METRICS_SQL.replace("\nSELECT CAST(b.session_day", "\nSELECT session_day, total_rev FROM (SELECT CAST(b.session_day") + ")", METRIC_ROLES)
def _series_daily_revenue(spark, sf_dir):
    return series.daily_revenue(silver.session_metrics(bronze_from_star(spark, sf_dir), P))


@query(
    "series_daily_acquisition",
    f"WITH {ACQUISITION} SELECT {text('date', 'acq_day')}, CAST(sum(daily_acquired_users) AS BIGINT) AS dau FROM acquired GROUP BY date",
    ("accounts",),
)
def _series_daily_acquisition(spark, sf_dir):
    return series.daily_acquisition(gold.acquisition_daily(bronze_from_star(spark, sf_dir), P))


@query(
    "series_daily_event_count",
    "SELECT CAST(CAST(event_date AS DATE) AS VARCHAR) AS event_day, count(*) AS events_count FROM events_role GROUP BY ALL",
    ("events",),
)
def _series_daily_event_count(spark, sf_dir):
    return series.daily_event_count(bronze_from_star(spark, sf_dir).events)


@query(
    "series_daily_revenue_by_offer",
    f"""
WITH {OFFERS}
SELECT {text('event_date')}, {', '.join(f"sum(CASE WHEN offer_id = '{o}' THEN total_revenue ELSE 0 END) AS {o}" for o in SERIES_OFFERS)}
FROM (SELECT * REPLACE (CAST(total_revenue AS DECIMAL(18,2)) AS total_revenue) FROM offers) GROUP BY event_date""".replace(
        "ELSE 0 END) AS", "ELSE 0 END)::DOUBLE AS"
    ),
    ("events", "exchange_rate"),
)
def _series_daily_revenue_by_offer(spark, sf_dir):
    return series.daily_revenue_by_offer(gold.biz_offer_performance(bronze_from_star(spark, sf_dir), P))


@query("series_ad_roas_ranking", f"WITH {MARKETING} SELECT ad_name, roas FROM ad_rows ORDER BY roas DESC NULLS LAST", MARKETING_ROLES)
def _series_ad_roas_ranking(spark, sf_dir):
    return series.ad_roas_ranking(gold.marketing_ad_metrics(bronze_from_star(spark, sf_dir), P))
