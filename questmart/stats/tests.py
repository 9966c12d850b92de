"""Two-sample tests on aggregates."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame

from questmart.stats.distributions import chi2_one_dof, f_upper, normal_two_sided, t_two_sided
from questmart.stats.samples import NO_ROWS, Moments, collect_moments, deviations, rank_sums

ALPHA = 0.05
NAN = float("nan")


@dataclass(frozen=True)
class Outcome:
    test: str
    statistic: float
    p: float


def decision(p: float) -> str:
    """A p-value that is not a number rejects nothing."""
    return "Reject H0" if p < ALPHA else "Fail to reject H0"


def normality_p(m: Moments) -> float:
    """Jarque-Bera from the moments, at every size. A constant sample passes."""
    if math.isnan(m.skewness) or math.isnan(m.kurtosis):
        return 1.0
    return math.exp(-(m.n / 6) * (m.skewness**2 + m.kurtosis**2 / 4) / 2)


def student_t(a: Moments, b: Moments) -> Outcome:
    dof = a.n + b.n - 2
    if dof < 1:
        return Outcome("student_t", NAN, NAN)
    pooled = ((a.n - 1) * a.variance + (b.n - 1) * b.variance) / dof
    return _t("student_t", a, b, pooled * (1 / a.n + 1 / b.n), dof)


def welch_t(a: Moments, b: Moments) -> Outcome:
    if a.n < 2 or b.n < 2:
        return Outcome("welch_t", NAN, NAN)
    va, vb = a.variance / a.n, b.variance / b.n
    if va + vb == 0:
        return Outcome("welch_t", NAN, NAN)
    dof = (va + vb) ** 2 / (va**2 / (a.n - 1) + vb**2 / (b.n - 1))
    return _t("welch_t", a, b, va + vb, dof)


def _t(name: str, a: Moments, b: Moments, squared_error: float, dof: float) -> Outcome:
    if math.isnan(squared_error) or squared_error <= 0:
        return Outcome(name, NAN, NAN)
    t = (a.mean - b.mean) / math.sqrt(squared_error)
    return Outcome(name, t, t_two_sided(t, dof))


def levene(sample: DataFrame, a: Moments, b: Moments, first: str, second: str) -> Outcome:
    """Equality of variances around the group means."""
    spread = collect_moments(deviations(sample, {first: a.mean, second: b.mean}))
    da, db = spread.get(first, NO_ROWS), spread.get(second, NO_ROWS)
    n = da.n + db.n
    inside = (da.n - 1) * da.variance + (db.n - 1) * db.variance if min(da.n, db.n) > 1 else NAN
    if math.isnan(inside) or inside <= 0 or n < 3:
        return Outcome("levene", NAN, NAN)
    grand = (da.n * da.mean + db.n * db.mean) / n
    between = da.n * (da.mean - grand) ** 2 + db.n * (db.mean - grand) ** 2
    w = (n - 2) * between / inside
    return Outcome("levene", w, f_upper(w, 1, n - 2))


def mann_whitney(sample: DataFrame, first: str, second: str) -> Outcome:
    """U of the first sample; normal approximation with tie and continuity correction."""
    row = rank_sums(sample, first, second).first()
    n1, n2, u1 = row["n1"], row["n2"], row["u1"]
    if not n1 or not n2:
        return Outcome("mann_whitney", NAN, NAN)
    n = n1 + n2
    spread = n1 * n2 / 12 * ((n + 1) - row["ties"] / (n * (n - 1)))
    if spread <= 0:
        return Outcome("mann_whitney", u1, NAN)
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / math.sqrt(spread)
    # A difference inside the continuity correction leaves no evidence at all.
    return Outcome("mann_whitney", u1, normal_two_sided(z) if z > 0 else 1.0)


def continuous(sample: DataFrame, first: str = "control", second: str = "test") -> tuple[str, Outcome]:
    """Chooses the test for (side, x): normal and equal variances, normal only, or neither."""
    moments = collect_moments(sample)
    a, b = moments.get(first, NO_ROWS), moments.get(second, NO_ROWS)
    if normality_p(a) > ALPHA and normality_p(b) > ALPHA:
        if levene(sample, a, b, first, second).p > ALPHA:
            return "parametric: Student t (equal var)", student_t(a, b)
        return "parametric: Welch t (unequal var)", welch_t(a, b)
    return "nonparametric: Mann–Whitney U", mann_whitney(sample, first, second)


@dataclass(frozen=True)
class Proportions:
    z: Outcome
    chi2: Outcome
    ci_low: float
    ci_high: float


def proportions(x1: int, n1: int, x2: int, n2: int) -> Proportions:
    """Pooled two-proportion z, Yates-corrected chi-square and the Wald interval of second minus first."""
    if not n1 or not n2:
        return Proportions(Outcome("prop_z", NAN, NAN), Outcome("chi2", NAN, NAN), NAN, NAN)
    p1, p2, pooled = x1 / n1, x2 / n2, (x1 + x2) / (n1 + n2)
    error = math.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
    z = (p1 - p2) / error if error else NAN
    chi2 = NAN
    if error:
        n = n1 + n2
        cross = abs(x1 * (n2 - x2) - x2 * (n1 - x1))
        chi2 = n * max(0.0, cross - n / 2) ** 2 / ((x1 + x2) * (n - x1 - x2) * n1 * n2)
    half = 1.959963984540054 * math.sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2)
    return Proportions(
        Outcome("prop_z", z, normal_two_sided(z) if error else NAN),
        Outcome("chi2", chi2, chi2_one_dof(chi2) if error else NAN),
        p2 - p1 - half,
        p2 - p1 + half,
    )
