"""Sessions from events, rolling offers, ad views, links."""

import json
import random

import pytest
from pyspark.sql import functions as F

from questmart.operators import acquisition, adviews, counters
from questmart.operators.sessionize import assign_sessions, first_events, parts_of_place, recent_offers, session_rollup, time_place
from tests.tables import at, event, frame


def stream(spark, steps):
    rows = []
    for n, (account, minute, what) in enumerate(steps):
        kind, subtype = {
            "in": ("authentication", "user_login"), "out": ("authentication", "user_logout"), "crash": ("error", "app_crash"), "play": ("progression", "level_start")
        }[what]
        payload = {"device_model": "iPhone 9", "os_version": "1", "app_version": "2"} if what == "in" else {}
        rows.append(event(n, kind, subtype, f"2025-01-01 10:{minute:02d}:00", account, None, **payload))
    return frame(spark, "events", rows)


STEPS = [
    ("a", 0, "play"), ("a", 1, "in"), ("b", 2, "in"), ("a", 3, "crash"), ("a", 4, "out"), ("a", 5, "out"), ("a", 6, "play"),
    ("b", 7, "play"), ("b", 8, "in"), ("b", 9, "play"), ("c", 10, "in"), ("c", 11, "out"), ("d", 12, "out"), ("b", 13, "crash"),
]


def test_sessions_follow_login_and_logout(spark):
    got = {r.event_id: r.session_id for r in assign_sessions(stream(spark, STEPS)).collect()}
    assert got == {0: None, 1: 1, 2: 2, 3: 1, 4: 1, 5: None, 6: None, 7: 2, 8: 3, 9: 3, 10: 4, 11: 4, 12: None, 13: 3}


def test_rollup_reads_the_event_before_logout(spark):
    accounts = frame(spark, "accounts", [{"account_id": "a", "country": "X"}])
    got = {r.session_id: r for r in session_rollup(assign_sessions(stream(spark, STEPS)), accounts).collect()}
    assert (got[1].end_reason, got[1].region, got[1].platform) == ("app_crash", "X", "iOS")
    assert (got[4].end_reason, got[4].region) == ("player_exit", "Unknown")
    assert (got[3].session_end, got[3].end_reason) == (None, None)
    assert (got[1].session_start, got[1].session_end) == (at("2025-01-01 10:01:00"), at("2025-01-01 10:04:00"))


def test_random_streams_by_replay(spark):
    rng = random.Random(11)
    steps = [(rng.choice("abc"), m, rng.choice(["in", "out", "play", "crash"])) for m in range(60)]
    got = {r.event_id: r.session_id for r in assign_sessions(stream(spark, steps)).collect()}
    open_sessions, count, want = {}, 0, {}
    for n, (account, _, what) in enumerate(steps):
        if what == "in":
            count += 1
            open_sessions[account] = count
        want[n] = open_sessions.get(account)
        if what == "out":
            open_sessions.pop(account, None)
    assert got == want


def test_first_event(spark):
    got = {r.account_id: r.event_id for r in first_events(stream(spark, STEPS)).collect()}
    assert got == {"a": 0, "b": 2, "c": 10, "d": 12}


def test_places_keep_the_order_of_date_and_id(spark):
    dates = [None, "1955-03-01 00:00:00.000001", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2025-01-01 10:00:00.5", "9999-12-31 00:00:00"]
    ids = [None, -(2**63), -1, 0, 7, 2**63 - 1]
    rows = [(n, d, i) for n, (d, i) in enumerate((d, i) for d in dates for i in ids)]
    df = spark.createDataFrame(random.Random(5).sample(rows, len(rows)), "n INT, d STRING, i BIGINT").withColumn("d", F.col("d").cast("timestamp"))
    at, row_id = parts_of_place(F.col("place"))
    placed = df.withColumn("place", time_place("d", "i")).withColumn("same", at.eqNullSafe(F.col("d")) & row_id.eqNullSafe(F.col("i")))
    got = placed.orderBy("place").collect()
    assert [r.n for r in got] == list(range(len(rows))) and all(r.same for r in got)
    assert len({r.place for r in got}) == len(rows)


def test_recent_offers_window(spark):
    buys = [
        (1, "a", "2025-01-01 23:59:59.500000", "x"), (2, "a", "2025-01-02 23:59:59.500000", "y"), (3, "a", "2025-01-02 23:59:59.500001", "x"),
        (4, "a", "2025-01-04 00:00:00", "z"), (5, "b", "2025-01-02 12:00:00", "x"),
    ]
    df = spark.createDataFrame([(n, a, at(t), o) for n, a, t, o in buys], "n INT, account_id STRING, event_time TIMESTAMP, offer_id STRING")
    got = {r.n: r.recent_offers for r in recent_offers(df).collect()}
    assert got == {1: [], 2: ["x"], 3: ["y"], 4: [], 5: []}


def test_paid_views_once_per_account(spark):
    events = frame(spark, "events", [event(n, "ad", "ad_shown", f"2025-01-01 10:0{n}:00", "a", 1, ad_id="cpi" if n < 3 else "cpm") for n in range(5)])
    ads = frame(spark, "hosted_ads", [
        {"ad_id": "cpi", "pricing_model": "CPI", "value_per_action": 2.0}, {"ad_id": "cpm", "pricing_model": "CPM", "value_per_action": 2.0}
    ])
    got = sorted((r.interaction_type, r.revenue, r.interaction_time.minute) for r in adviews.paid_views(events, ads).collect())
    assert got == [("install", 2.0, 0), ("view", 0.002, 3), ("view", 0.002, 4)]
    assert {r.ad_id: r.exposure_count for r in adviews.exposures(events).collect()} == {"cpi": 3, "cpm": 2}


def test_acquisition_lookups(spark):
    people = spark.createDataFrame([("Japan",), ("Spain",), ("Kenya",), ("Atlantis",), (None,)], "country STRING")
    got = {r.country: (r.currency_name, r.market_multiplier) for r in acquisition.with_currency(people).collect()}
    assert got == {"Japan": ("JPY", 0.7), "Spain": ("EUR", 0.9), "Kenya": ("USD", 0.5), "Atlantis": ("USD", 1.0), None: ("USD", 1.0)}

    campaigns = frame(spark, "campaigns", [{"campaign_id": 1, "acquisition_source": "TikTok Ads", "associated_ads": "[1,2,3]"}])
    ads = frame(spark, "ads", [
        {"ad_id": i, "pricing_model": m, "impression_count": 4000, "click_count": 30, "install_count": 50, "action_count": 7, "cost_per_interaction": 2.0}
        for i, m in enumerate(["CPC", "CPM", "CPI"])
    ])
    cost = acquisition.campaign_costs(campaigns, ads).first()
    assert (cost.ads, float(cost.total_cost), float(cost.budget)) == (3, 108.0, 1000.0)
    players = acquisition.expected_players(campaigns, ads, acquisition.PLAY_RATES).collect()
    assert [int(r.install_count) for r in players] == [38, 38]

    meta = lambda who: json.dumps({"referral_account_id": who, "referral_code": f"c{who}"})
    accounts = frame(spark, "accounts", [
        {"account_id": "1", "signup_date": at("2025-01-01")},
        {"account_id": "2", "signup_date": at("2025-01-02"), "acquisition_metadata": meta("1")},
        {"account_id": "3", "signup_date": at("2025-01-03"), "acquisition_metadata": meta("1")},
    ])
    links = {r.account_id: (r.referred_friend, r.referral_timestamp) for r in acquisition.referral_links(accounts).collect()}
    assert links == {"1": (True, at("2025-01-03")), "2": (False, None), "3": (False, None)}


def test_top_k_share(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2), ("d", 1)], "f STRING, v INT")
    got = [(r.f, float(r.share)) for r in counters.top_k_with_share(df, "f", "v", 3).orderBy("f").collect()]
    assert got == [("a", 50.0), ("b", 30.0), ("c", 20.0)]


def test_one_busy_account_and_day_of_purchases(spark):
    rows = [(i, "a", f"2025-01-01 {i // 60 % 24:02d}:{i % 60:02d}:{i % 7:02d}", f"o{i % 5}" if i % 11 else None) for i in range(1_200)]
    rows += [(5_000, "a", "2025-01-02 12:00:00", "z"), (5_001, "a", "2025-01-03 12:00:00", "z"), (5_002, "a", "2025-01-03 12:00:01", None)]
    bought = spark.createDataFrame(rows, "event_id BIGINT, account_id STRING, at STRING, offer_id STRING")
    bought = bought.selectExpr("event_id", "account_id", "CAST(at AS TIMESTAMP) AS event_time", "offer_id")
    got = {r.event_id: r.recent_offers for r in recent_offers(bought).collect()}
    times = {r.event_id: (r.event_time, r.offer_id) for r in bought.collect()}
    for event, (at, _) in times.items():
        want = {o for t, o in times.values() if o and t < at and (at - t).total_seconds() <= 86_400}
        assert got[event] == sorted(want)
