"""Marts on hand-made rows: the cases where results are easy to get wrong."""

import math
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from questmart.functions import money, segments
from questmart.operators import histograms
from questmart.operators.currency import purchases_in_usd
from questmart.operators.histograms import discrete_quantiles, most_common, quantiles_and_modes
from questmart.params import Params
from questmart.plans import analytics, gold, series, silver
from questmart.sources.star_tables import bronze_from_star
from tests.tables import at, bronze, event, frame, sale, session

P = Params()


def rows(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_params_reject_swapped_dates():
    with pytest.raises(ValueError):
        Params(start_date=P.end_date, end_date=P.start_date)


def test_money_by_table_and_by_event_rate(spark):
    t = bronze(
        spark,
        events=[
            sale(1, "2025-03-04 10:00:00", "a", 1, cost=8.8169, currency="EUR", rate=2.0),
            sale(2, "2025-03-04 10:00:00", "a", 1, cost=5, currency="ZZZ", rate=0),
            sale(3, "2025-03-04 10:00:00", "a", 1, cost="x", currency="USD"),
        ],
    )
    got = rows(purchases_in_usd(t.events, t.exchange_rate), "event_id")
    assert (got[1].usd, got[1].usd_event) == (Decimal("10.00"), Decimal("4.41"))
    assert (got[2].usd, got[2].usd_event) == (Decimal("5.00"), None)
    assert got[3].usd is None


def test_ratio_of_zero_divisor_is_null(spark):
    row = spark.range(1).select(money.ratio(F.lit(1), F.lit(0), 2).alias("r"), money.percent(F.lit(1), F.lit(3)).alias("p")).first()
    assert (row.r, row.p) == (None, Decimal("33.33"))


def test_quantiles_and_modes(spark):
    df = spark.createDataFrame([("k", v) for v in (10, 20, 30, 40)] + [("n", None)], "k STRING, v INT")
    got = rows(discrete_quantiles(df, ["k"], F.col("v").cast("double"), {"q": 0.10, "u": 0.75}, median="m"), "k")
    assert (got["k"].q, got["k"].u, got["k"].m) == (10.0, 30.0, 25.0)
    assert "n" not in got
    tied = spark.createDataFrame([("k", x) for x in ("b", "a", "b", "a", "c")], "k STRING, x STRING")
    assert most_common(tied, ["k"], F.col("x"), "x").first().x == "a"


def test_quantiles_and_modes_from_one_read(spark):
    given = [("k", 10, "b", 9), ("k", 40, "a", 10), ("k", 20, "b", 10), ("k", 30, "a", None), ("n", None, None, None), (None, 5, "", -1)]
    df = spark.createDataFrame(given, "k STRING, v INT, x STRING, h INT")
    modes = {"x_mode": F.col("x"), "h_mode": F.col("h")}
    got = rows(quantiles_and_modes(df, ["k"], F.col("v"), {"q": 0.10, "u": 0.75}, "m", modes), "k")
    assert tuple(got["k"]) == ("k", 10.0, 30.0, 25.0, "a", 10)
    assert tuple(got[None]) == (None, 5.0, 5.0, 5.0, "", -1)
    # Nothing known, no row; numbers are ordered as numbers.
    assert "n" not in got
    tied = spark.createDataFrame([("k", 1, "x", 10), ("k", 1, "x", 9)], df.schema)
    assert quantiles_and_modes(tied, ["k"], F.col("v"), {"q": 0.10}, "m", modes).first().h_mode == 9
    assert quantiles_and_modes(df.limit(0), ["k"], F.col("v"), {"q": 0.10}, "m", modes).count() == 0


def test_rank_of_exact_percentage(spark):
    df = spark.range(1, 701).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    assert discrete_quantiles(df, ["k"], F.col("v"), {"q": 0.33}).first().q == 231.0


def test_session_metrics_tags_and_unknowns(spark):
    t = bronze(
        spark,
        sessions=[
            session(1, "a", "2025-01-06 09:00:00"),
            session(2, "a", "2025-01-07 09:00:00"),
            session(3, "a", "2025-01-08 09:00:00"),
            session(4, "b", "2025-01-07 10:00:00", platform="Android"),
            session(5, "a", "2025-01-07 10:30:00"),
            session(6, "a", "2025-01-07 09:10:00"),
        ],
        events=[sale(1, "2025-01-07 10:00:00", "b", 4, cost=3), event(2, "ad", "ad_shown", "2025-01-07 10:00:00", "b", 4, ad_id="x")],
    )
    got = rows(silver.session_metrics(t, P), "session_day")
    day = got[at("2025-01-07").date()]
    assert (day.unique_players, day.new_accounts, day.churned_accounts, day.stopover_accounts, day.retained_accounts) == (2, 1, 1, 1, 1)
    assert day.day_of_week == "Tue" and day.peak_hour_of_day == 9
    assert (day.sessions_with_purchase, day.sessions_with_ads, day.total_ad_events) == (1, 1, 1)
    assert day.total_purchase_rev == Decimal("3.00") and day.total_ad_rev is None and day.total_rev is None
    assert day.arppu == Decimal("3.00") and day.arpu_purchase == Decimal("1.50")
    quiet = got[at("2025-01-06").date()]
    assert (quiet.sessions_with_purchase, quiet.purchasing_unique_accounts) == (0, None)
    for r in got.values():
        assert r.retained_accounts + r.new_accounts + r.churned_accounts - r.stopover_accounts == r.unique_players


def _account(name, signup, **more):
    return {"account_id": name, "signup_date": at(signup), **more}


def test_retention_windows(spark):
    days = {"same": "2025-01-01", "day7": "2025-01-08", "day8": "2025-01-09", "day30": "2025-01-31", "day31": "2025-02-01"}
    t = bronze(
        spark,
        accounts=[_account(n, "2025-01-01 00:00:00") for n in days],
        sessions=[session(i, n, f"{d} 12:00:00") for i, (n, d) in enumerate(days.items())],
        events=[sale(i, f"{d} 12:00:00", n, i) for i, (n, d) in enumerate(days.items())],
    )
    got = rows(silver.accounts_extended(t, P), "account_id")
    assert {n: got[n].retained_within_7_days for n in days} == {"same": False, "day7": True, "day8": False, "day30": False, "day31": False}
    assert {n: got[n].retained_within_30_days for n in days} == {"same": False, "day7": False, "day8": True, "day30": True, "day31": False}
    assert {n: got[n].monetized_within_7_days for n in days} == {"same": True, "day7": True, "day8": False, "day30": False, "day31": False}


def test_signup_with_time_of_day_excludes_its_day(spark):
    t = bronze(
        spark,
        accounts=[_account("a", "2025-01-01 08:00:00")],
        sessions=[session(1, "a", "2025-01-01 12:00:00")],
        events=[sale(1, "2025-01-01 12:00:00", "a", 1)],
    )
    row = silver.accounts_extended(t, P).first()
    assert not row.retained_within_7_days and not row.monetized_within_7_days


def _move(number, account, session_id, direction, item, amount, reason):
    return event(
        number, "resource", f"{direction}_item", "2025-01-02 10:00:00", account, session_id,
        item_category="currency", item_id=item, item_amount=amount, reason=reason,
    )


def test_currency_flows(spark):
    t = bronze(
        spark,
        sessions=[session(i, n, "2025-01-02 09:00:00") for i, n in enumerate(["both", "source", "sink", "none", "chest"])],
        events=[
            _move(1, "both", 0, "source", "currency_gold", 50, "LEVEL_001"),
            _move(2, "both", 0, "source", "currency_gold", 70, "LEVEL_002"),
            _move(3, "both", 9, "source", "currency_gold", 30, "daily"),
            _move(4, "both", 9, "source", "currency_gold", 0, "zero"),
            _move(5, "both", 9, "sink", "currency_gold", 40, "shop"),
            _move(6, "source", 1, "source", "currency_diamond", 5, "TUTORIAL_001"),
            _move(7, "sink", 2, "sink", "currency_gold", 4, "shop"),
            _move(8, "chest", 4, "source", "chest_rare", 1, "shop"),
        ],
    )
    got = rows(silver.accounts_extended(t, P), "account_id")
    both = got["both"]
    assert (both.gold_source_event_count, both.gold_source_session_count, both.total_gold_earned) == (4, 2, 150)
    assert both.gold_source_distribution == '{"level_progression":120,"daily":30}'
    assert (both.gold_sink_distribution, both.diamond_source_distribution) == ('{"shop":40}', "{}")
    assert (both.total_gold_spent, both.current_gold, both.top_gold_earn_reason) == (40, 110, "level_progression")
    assert got["source"].current_diamond == 5 and got["source"].top_diamond_earn_reason == "tutorial_progression"
    assert (got["source"].total_gold_earned, got["source"].gold_source_event_count) == (None, 0)
    assert (got["sink"].current_gold, got["sink"].total_gold_spent, got["sink"].gold_source_event_count) == (None, 4, None)
    assert got["none"].top_gold_spend_reason == "None" and got["none"].total_gold_spent == 0
    assert got["chest"].gold_source_event_count == 0


def test_account_purchases_and_latest_session(spark):
    t = bronze(
        spark,
        accounts=[_account("a", "2025-01-01 00:00:00", referral_source="ad_ig", acquisition_metadata='{"ad_name":"x"}')],
        sessions=[
            session(1, "a", "2025-03-29 09:00:00", region="R1", end_reason="app_crash"),
            session(2, "a", "2025-03-29 09:00:00", region="R2", end_reason=None),
        ],
        events=[
            sale(1, "2025-03-01 10:00:00", "a", 1, offer="off_subscription_basic", cost=60),
            sale(2, "2025-03-21 10:00:00", "a", 1, offer="off_z", cost=60),
            event(3, "progression", "level_success", "2025-03-21 10:00:00", "a", 1, level_id="LEVEL_081"),
        ],
    )
    row = silver.accounts_extended(t, P).first()
    assert (row.current_country, row.error_count, row.session_count) == ("R2", 1, 2)
    assert (row.number_of_purchases, row.most_purchased_item, row.total_purchase) == (2, "off_subscription_basic", Decimal("120.00"))
    assert (row.monetization_segment, row.completion_segment, row.acquisition_segment) == ("whale", "endgame", "paid_social")
    assert (row.subscription_status, row.purchase_recency_days, row.ad_name, row.search_query) == ("active", 10, "x", "N/A")


def test_segments(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 1, 20, 21, 51, 81, 100, 101)], "v INT")
    got = rows(df.select("v", segments.completion(F.col("v")).alias("s")), "v")
    assert [got[v].s for v in (None, 20, 21, 51, 81, 100, 101)] == [
        "starter", "starter", "mid_stage", "late_stage", "endgame", "completed", "endgame"
    ]
    spent = spark.createDataFrame([(None,), (0.5,), (1.0,), (99.9,), (100.0,), (500.0,)], "v DOUBLE")
    got = rows(spent.select("v", segments.monetization(F.col("v")).alias("s")), "v")
    assert [r.s for r in got.values()] == ["minnow", "minnow", "dolphin", "dolphin", "whale", "kraken"]


def test_offers_count_distinct_over_wider_periods(spark):
    t = bronze(
        spark,
        events=[
            sale(1, "2025-01-06 10:00:00", "a", 1),
            sale(2, "2025-01-07 10:00:00", "a", 2),
            sale(3, "2025-01-07 11:00:00", "b", None),
            sale(4, "2025-02-03 11:00:00", "b", 3),
            sale(5, "2025-01-07 11:00:00", "c", 4, category=None),
        ],
    )
    got = rows(gold.biz_offer_performance(t, P), "event_date", "reward_category")
    tuesday = got[(at("2025-01-07").date(), '["currency"]')]
    assert (tuesday.purchase_count, tuesday.daily_unique_buyers, tuesday.daily_purchase_sessions) == (2, 2, 1)
    assert (tuesday.weekly_unique_buyers, tuesday.weekly_purchase_sessions) == (2, 2)
    assert (tuesday.monthly_unique_buyers, tuesday.total_unique_buyers, tuesday.total_purchase_sessions) == (2, 2, 3)
    assert tuesday.avg_revenue_per_purchasing_sessions == Decimal("20.00")
    bare = got[(at("2025-01-07").date(), None)]
    assert (bare.daily_unique_buyers, bare.weekly_unique_buyers, bare.total_unique_buyers) == (1, 0, 0)
    wide = rows(series.daily_revenue_by_offer(gold.biz_offer_performance(t, P), ["off_a", "off_b"]), "event_date")
    assert (wide[at("2025-01-07").date()].off_a, wide[at("2025-01-07").date()].off_b) == (Decimal("30.00"), 0)


def test_cohorts_tell_unreached_from_empty(spark):
    t = bronze(
        spark,
        accounts=[_account("a", "2025-01-01 05:00:00"), _account("b", "2025-01-01 09:00:00")],
        sessions=[
            session(1, "a", "2025-01-01 12:00:00"),
            session(2, "a", "2025-01-02 12:00:00"),
            session(3, "a", "2025-01-02 18:00:00"),
            session(4, "b", "2025-01-01 12:00:00"),
            session(5, "b", "2025-01-10 12:00:00"),
        ],
    )
    people = silver.accounts_extended(t, P).withColumn("engagement_segment", F.lit("e"))
    row = gold.cohort_churn(t, people, P).first()
    assert row.referral_source is None
    assert (row.day_0, row.day_1_return, row.day_7_return, row.day_14_return) == (2, 1, 0, None)
    assert (row.day_1_churn, row.day_7_churn, row.day_14_churn) == (1, 2, None)
    assert (row.retention_rate_day1, row.churn_rate_day7) == (Decimal("50.00"), Decimal("100.00"))


def test_level_funnel(spark):
    def step(n, account, level, what):
        return event(n, "progression", f"level_{what}", f"2025-01-01 10:00:{n:02d}", account, 1, **({"level_id": level} if level else {}))

    t = bronze(
        spark,
        events=[
            step(1, "a", "LEVEL_001", "start"), step(2, "a", "LEVEL_001", "fail"), step(3, "a", "LEVEL_001", "start"),
            step(4, "a", "LEVEL_001", "success"), step(5, "b", "LEVEL_001", "start"), step(6, "b", "LEVEL_001", "fail"),
            step(7, "c", "LEVEL_001", "start"), step(8, "c", "TUTORIAL_001", "start"), step(9, "c", None, "start"),
            step(10, "d", "LEVEL_002", "start"),
        ],
    )
    got = rows(gold.level_progression(t, P), "level_id")
    assert set(got) == {"LEVEL_001", "LEVEL_002"}
    one = got["LEVEL_001"]
    assert (one.attempt_count, one.success_count, one.fail_count, one.resolved_fail_count, one.leavers, one.error_count) == (4, 1, 2, 1, 1, 1)
    assert (one.completion_rate, one.error_pct, one.avg_fail) == (Decimal("25.00"), Decimal("0.250"), Decimal("0.33"))
    assert (got["LEVEL_002"].leavers, got["LEVEL_002"].resolved_fail_count) == (None, None)


def test_hosted_ads_by_interaction_type(spark):
    def ad(name, model):
        return {"ad_id": name, "pricing_model": model, "value_per_action": 2.0}

    def act(n, name, kind):
        return {"interaction_id": n, "ad_id": name, "interaction_type": kind, "revenue": 0.1}

    t = bronze(
        spark,
        hosted_ads=[ad("x", "CPM"), ad("y", "CPC"), ad("z", "CPA")],
        hosted_ad_interactions=[act(1, "x", "click"), act(2, "x", "click"), act(3, "x", "install"), act(4, "y", "click")],
        events=[event(n, "ad", "ad_shown", "2025-01-01 10:00:00", "a", 1, ad_id="x") for n in range(2)],
    )
    got = rows(gold.hosted_ad_metrics(t, P), "ad_id", "interaction_count")
    clicks = got[("x", 2)]
    assert (clicks.click_count, clicks.install_count, clicks.view_count, clicks.total_revenue) == (2, 0, 2, Decimal("0.00"))
    assert clicks.engagement_rate is None
    assert got[("x", 1)].engagement_rate == Decimal("50.00")
    assert (got[("y", 1)].engagement_rate, got[("y", 1)].total_revenue) == (None, Decimal("2.00"))
    assert got[("z", None)].click_count is None


def test_marketing_models(spark):
    models = ["CPM", "CPC", "CPI", "CPA", "OTHER"]
    t = bronze(
        spark,
        ads=[
            {"ad_id": i, "ad_name": m, "impression_count": 500, "click_count": 0 if m == "CPI" else 10, "install_count": 4, "action_count": 2, "cost_per_interaction": 3.0}
            for i, m in enumerate(models)
        ],
        ad_campaign_map=[{"mapping_id": i, "ad_id": i, "campaign_id": i} for i in range(5)],
        campaigns=[{"campaign_id": i, "campaign_name": m, "campaign_type": m} for i, m in enumerate(models)],
        accounts=[
            _account("a", "2025-01-01 00:00:00", acquisition_metadata='{"ad_name":"CPA"}', email_is_anonymized=False),
            _account("b", "2025-01-01 00:00:00", acquisition_metadata='{"ad_name":"CPA"}', email_is_anonymized=True),
        ],
        events=[sale(1, "2025-01-02 00:00:00", "a", 1, cost=12)],
    )
    got = rows(gold.marketing_ad_metrics(t, P), "ad_name")
    assert [float(got[m].spend) if got[m].spend is not None else None for m in models] == [1.5, 30.0, 12.0, 6.0, None]
    assert (got["CPI"].cvr, got["CPI"].ctr) == (None, Decimal("0.00"))
    cpa = got["CPA"]
    assert (cpa.acr, cpa.cpa, cpa.roas, cpa.signup_count) == (Decimal("50.00"), Decimal("3.00"), Decimal("2.00"), 2)
    assert got["CPC"].acr is None


def test_experiment_marts(spark):
    t = bronze(
        spark,
        sessions=[
            session(1, "a", "2025-03-03 00:00:00", app_version=P.test_version),
            session(2, "a", "2025-03-04 10:00:00", app_version=P.test_version),
            session(3, "b", "2025-03-04 10:00:00", app_version=P.control_version),
            session(4, "c", "2025-03-02 23:59:59", app_version=P.test_version),
            session(5, "d", "2025-03-04 10:00:00", app_version="9"),
        ],
        events=[
            sale(1, "2025-03-03 01:00:00", "a", 1, cost=4),
            sale(2, "2025-03-04 11:00:00", "a", 2, cost=6),
            sale(3, "2025-03-04 12:00:00", "a", 2, cost=1),
            sale(4, "2025-03-04 12:00:00", "b", 3, cost=0),
            sale(5, "2025-03-04 12:00:00", "b", 3, cost=9, rate=0),
        ],
    )
    people = silver.accounts_extended(t, P)
    sales = analytics.ab_test_daily_revenue(t, people, P).collect()
    test = sorted((r.cost_usd, r.cumulative_revenue) for r in sales if r.group_type == "test")
    assert test == [(Decimal("1.00"), Decimal("11.00")), (Decimal("4.00"), Decimal("4.00")), (Decimal("6.00"), Decimal("11.00"))]
    eda = rows(analytics.ab_test_eda(t, people, P), "account_id")
    assert set(eda) == {"a", "b"}
    assert (eda["a"].session_count, eda["a"].purchase_count, eda["a"].avg_rev_per_ses) == (2, 3, Decimal("5.50"))
    assert eda["b"].converted and eda["b"].total_revenue == 0 and eda["b"].purchase_count == 2
    daily = rows(analytics.ab_test_daily_accounts(t, P), "session_date")
    assert (daily[at("2025-03-04").date()].control_unique_accounts, daily[at("2025-03-04").date()].test_session_count) == (1, 1)


def test_equipment_looks_at_the_next_event(spark):
    def step(n, session_id, what, **payload):
        return event(n, "progression", f"level_{what}", f"2025-01-01 10:00:{n:02d}", "a", session_id, level_id="LEVEL_001", **payload)

    t = bronze(
        spark,
        events=[
            step(1, 1, "start", equipped_hero="h1"), step(2, 1, "success", total_score=900, stars_gained=2),
            step(3, 1, "start", equipped_hero="h3"), step(4, 1, "fail", total_score=100),
            step(5, 1, "start", equipped_hero="h5"), step(6, 2, "success", total_score=1, stars_gained=1),
        ],
    )
    got = rows(analytics.equipment_contribution_eda(t, P), "equipped_hero")
    assert {h: (r.is_attempt_successful, r.total_score, r.stars_gained) for h, r in got.items()} == {
        "h1": (True, "900", "2"), "h3": (False, "100", "0"), "h5": (None, None, "0")
    }


@pytest.mark.parametrize("bins", [50, 4096])
def test_narrowed_quantiles_against_sorting(spark, bins):
    rng = random.Random(bins)
    columns = {
        "whole": [float(rng.randrange(1000)) for _ in range(500)],
        "same": [7.0] * 500,
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)],
        "holes": [None if i % 3 else float("nan") if i % 2 else float(i) for i in range(500)],
        "huge": [rng.choice([-1.7e308, 1.7e308, 0.0, 5e-324]) for _ in range(500)],
        "none": [None] * 500,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} DOUBLE" for c in columns)).repartition(3)
    wanted = {"p0": 0.0, "p33": 0.33, "p66": 0.66, "p100": 1.0}
    got = histograms.narrowed_quantiles(df, list(columns), wanted, bins)
    for name, values in columns.items():
        known = sorted(v for v in values if v is not None and v == v)
        for q, p in wanted.items():
            place = max(math.ceil(Decimal(str(p)) * len(known)), 1) - 1
            assert got[name][q] == (known[place] if known else None), (name, q)
