"""The A/B report: six tests on three analytics tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.stats.samples import NO_ROWS, arpdau, collect_moments, conversion_counts
from questmart.stats.tests import ALPHA, continuous, decision, levene, mann_whitney, normality_p, proportions, student_t, welch_t

REPORT_SCHEMA = (
    "metric STRING, domain STRING, test_used STRING, basis STRING, statistic DOUBLE, p_value DOUBLE, alpha DOUBLE, "
    "decision STRING, ci_compare STRING, ci_method STRING, ci_low DOUBLE, ci_high DOUBLE, chi2_stat DOUBLE, "
    "chi2_p_value DOUBLE, chi2_dof INT"
)
STATISTICS = (
    "normality_control", "normality_test", "levene_w", "student_t", "welch_t", "u_control", "z", "chi2", "ci_low", "ci_high",
)


def account_sample(account_level: DataFrame, value: str, converters_only: bool) -> DataFrame:
    rows = account_level.where(F.col("converted")) if converters_only else account_level
    return rows.select(F.col("group_type").alias("side"), F.col(value).cast("double").alias("x"))


def arpdau_sample(daily: DataFrame) -> DataFrame:
    sides = F.explode(
        F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_arpdau").alias("x")) for s in ("control", "test")])
    )
    return daily.select(sides.alias("v")).select("v.*")


def continuous_samples(daily_revenue: DataFrame, daily_accounts: DataFrame, account_level: DataFrame) -> dict[str, DataFrame]:
    """(side, x) of each continuous metric."""
    return {
        "ARPDAU (daily)": arpdau_sample(arpdau(daily_revenue, daily_accounts)),
        "Total Revenue / Account (all users)": account_sample(account_level, "total_revenue", False),
        "Total Revenue / Account (converters)": account_sample(account_level, "total_revenue", True),
        "Purchase Count / Account (all users)": account_sample(account_level, "purchase_count", False),
        "Purchase Count / Account (converters)": account_sample(account_level, "purchase_count", True),
    }


def _conversion(account_level: DataFrame):
    counts = {row["group_type"]: (row["converted"], row["accounts"]) for row in conversion_counts(account_level).collect()}
    return proportions(*counts.get("control", (0, 0)), *counts.get("test", (0, 0)))


def build_statistics(daily_revenue: DataFrame, daily_accounts: DataFrame, account_level: DataFrame) -> DataFrame:
    """Every statistic of every metric, whichever test the report chooses; six rows, NULL where a statistic has no value."""
    rows = []
    for label, sample in continuous_samples(daily_revenue, daily_accounts, account_level).items():
        moments = collect_moments(sample)
        a, b = moments.get("control", NO_ROWS), moments.get("test", NO_ROWS)
        outcomes = [levene(sample, a, b, "control", "test"), student_t(a, b), welch_t(a, b), mann_whitney(sample, "control", "test")]
        rows.append((label, normality_p(a), normality_p(b), *[o.statistic for o in outcomes], *(None,) * 4))
    result = _conversion(account_level)
    rows.append(("Conversion Rate", *(None,) * 6, result.z.statistic, result.chi2.statistic, result.ci_low, result.ci_high))
    known = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    schema = "metric STRING, " + ", ".join(f"{name} DOUBLE" for name in STATISTICS)
    return account_level.sparkSession.createDataFrame(known, schema)


def build_report(daily_revenue: DataFrame, daily_accounts: DataFrame, account_level: DataFrame) -> DataFrame:
    rows = []
    for label, sample in continuous_samples(daily_revenue, daily_accounts, account_level).items():
        basis, outcome = continuous(sample)
        rows.append(
            (label, "continuous", outcome.test, basis, outcome.statistic, outcome.p, ALPHA, decision(outcome.p))
            + (None,) * 7
        )
    result = _conversion(account_level)
    rows.append(
        (
            "Conversion Rate", "proportion", "two_proportion_z", "z + chi2", result.z.statistic, result.z.p, ALPHA,
            decision(result.z.p), "diff", "wald", result.ci_low, result.ci_high, result.chi2.statistic, result.chi2.p, 1,
        )
    )
    return account_level.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def _p(value: float | None) -> str:
    return "NA" if value is None or math.isnan(value) else f"{value:.4f}"


def render_text(report: DataFrame) -> str:
    """The report's rows (six at most) as a table in plain text, one measure per line."""
    lines = [f"Experiment report, significance level {ALPHA}"]
    for row in report.collect():
        parts = [f"{row['test_used']} = {row['statistic']:.3f}", f"p {_p(row['p_value'])}"]
        if row["domain"] == "proportion":
            parts.append(f"chi-square({row['chi2_dof']}) = {row['chi2_stat']:.3f}, p {_p(row['chi2_p_value'])}")
            parts.append(f"{row['ci_method']} interval of the difference {row['ci_low']:.6f} to {row['ci_high']:.6f}")
        lines.append(f"{row['metric']} by {row['basis']}: {'; '.join(parts)}; {row['decision']}")
    return "\n".join(lines) + "\n"
