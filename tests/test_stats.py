"""Tests on aggregates against textbook values and brute force."""

import math
import random

import pytest

from questmart.stats import distributions as d
from questmart.stats.report import REPORT_SCHEMA, build_report, render_text
from questmart.stats.samples import NO_ROWS, Moments, arpdau, collect_moments, rank_sums
from questmart.stats.tests import continuous, decision, levene, mann_whitney, normality_p, proportions, student_t, welch_t


def sample(spark, control, test):
    rows = [("control", float(x)) for x in control] + [("test", float(x)) for x in test]
    return spark.createDataFrame(rows, "side STRING, x DOUBLE")


def test_tails():
    assert d.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert d.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert d.f_upper(4.964602744, 1, 10) == pytest.approx(0.05, abs=1e-8)
    assert d.chi2_one_dof(3.841458821) == pytest.approx(0.05, abs=1e-9)
    assert d.regularized_beta(0.5, 2, 2) == pytest.approx(0.5)


def test_t_statistics(spark):
    m = collect_moments(sample(spark, [1, 2, 3, 4, 5], [2, 4, 6, 8, 10]))
    assert welch_t(m["control"], m["test"]).statistic == pytest.approx(-3 / math.sqrt(0.5 + 2))
    assert student_t(m["control"], m["test"]).statistic == pytest.approx(-1.8973665961)
    assert student_t(m["control"], m["test"]).p == pytest.approx(0.0943496, abs=1e-6)


def test_levene_by_hand(spark):
    df = sample(spark, [1, 2, 3], [2, 4, 9])
    m = collect_moments(df)
    a, b = [1.0, 0.0, 1.0], [3.0, 1.0, 4.0]
    ma, mb, g = sum(a) / 3, sum(b) / 3, sum(a + b) / 6
    inside = sum((x - ma) ** 2 for x in a) + sum((x - mb) ** 2 for x in b)
    want = 4 * (3 * (ma - g) ** 2 + 3 * (mb - g) ** 2) / inside
    assert levene(df, m["control"], m["test"], "control", "test").statistic == pytest.approx(want)


def _u_by_pairs(xs, ys):
    return sum((x > y) + 0.5 * (x == y) for x in xs for y in ys)


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_sums_by_pairs(spark, seed):
    rng = random.Random(seed)
    xs, ys = [rng.randrange(20) for _ in range(80)], [rng.randrange(25) for _ in range(60)]
    first = rank_sums(sample(spark, xs, ys), "control", "test").first()
    second = rank_sums(sample(spark, xs, ys), "test", "control").first()
    assert first["u1"] == _u_by_pairs(xs, ys)
    assert first["u1"] + second["u1"] == 80 * 60
    counts = [(xs + ys).count(v) for v in set(xs + ys)]
    assert first["ties"] == sum(t**3 - t for t in counts)


def test_mann_whitney_p(spark):
    out = mann_whitney(sample(spark, [1, 2, 3, 4], [5, 6, 7, 8]), "control", "test")
    assert out.statistic == 0 and out.p == pytest.approx(d.normal_two_sided(7.5 / math.sqrt(12)))
    same = mann_whitney(sample(spark, [3, 3], [3, 3]), "control", "test")
    assert math.isnan(same.p)


def test_choice_of_test(spark):
    rng = random.Random(3)
    normal = [rng.gauss(0, 1) for _ in range(200)]
    assert continuous(sample(spark, normal, [x + 1 for x in normal]))[1].test == "student_t"
    assert continuous(sample(spark, normal, [x * 5 for x in normal]))[1].test == "welch_t"
    assert continuous(sample(spark, [x**8 for x in normal], normal))[1].test == "mann_whitney"
    # The decision does not depend on the size alone.
    assert normality_p(Moments(5000, 0, 1, 9, 9)) == 0.0 and normality_p(Moments(5001, 0, 1, 9, 9)) == 0.0
    basis, outcome = continuous(sample(spark, [2, 2, 2], [2, 2, 2]))
    assert outcome.test == "welch_t" and math.isnan(outcome.p) and decision(outcome.p) == "Fail to reject H0"
    assert math.isnan(student_t(NO_ROWS, NO_ROWS).p)


def test_proportions():
    r = proportions(30, 100, 45, 100)
    assert r.z.statistic == pytest.approx(-2.1908902300)
    assert r.chi2.statistic == pytest.approx(4.1813333333)
    half = 1.959963984540054 * math.sqrt(0.3 * 0.7 / 100 + 0.45 * 0.55 / 100)
    assert (r.ci_low, r.ci_high) == (pytest.approx(0.15 - half), pytest.approx(0.15 + half))
    assert math.isnan(proportions(0, 10, 0, 10).z.p)


def test_report(spark):
    revenue = spark.createDataFrame(
        [("2025-03-03", "control", 10.0), ("2025-03-03", "test", 8.0), ("2025-03-04", "test", 9.0)],
        "session_date STRING, group_type STRING, cost_usd DOUBLE",
    )
    accounts = spark.createDataFrame(
        [("2025-03-03", 2, 4), ("2025-03-04", 5, 3)],
        "session_date STRING, control_unique_accounts BIGINT, test_unique_accounts BIGINT",
    )
    level = spark.createDataFrame(
        [("control", True, 5.0, 1), ("control", False, 0.0, 0), ("test", True, 9.0, 2), ("test", True, 8.0, 1)],
        "group_type STRING, converted BOOLEAN, total_revenue DOUBLE, purchase_count BIGINT",
    )
    days = {r.session_date: (r.control_arpdau, r.test_arpdau) for r in arpdau(revenue, accounts).collect()}
    assert days == {"2025-03-03": (5.0, 2.0), "2025-03-04": (None, 3.0)}
    report = build_report(revenue, accounts, level)
    assert report.count() == 6 and len(report.columns) == REPORT_SCHEMA.count(",") + 1
    text = render_text(report)
    assert text.count("\n") == 7 and "chi-square(1)" in text and all(r.metric in text for r in report.collect())
