"""Tail probabilities of a few scalar test statistics."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_one_dof(x: float) -> float:
    return math.erfc(math.sqrt(x / 2))


def _beta_fraction(x: float, a: float, b: float) -> float:
    """Continued fraction of the incomplete beta function, by the modified Lentz method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 1000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            c = 1.0 + step / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            change = c * d
            value *= change
        if abs(change - 1.0) < 1e-15:
            break
    return value


def regularized_beta(x: float, a: float, b: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(x, a, b) / a
    return 1.0 - front * _beta_fraction(1 - x, b, a) / b


def t_two_sided(t: float, dof: float) -> float:
    return regularized_beta(dof / (dof + t * t), dof / 2, 0.5)


def f_upper(f: float, dof1: float, dof2: float) -> float:
    return regularized_beta(dof2 / (dof2 + dof1 * f), dof2 / 2, dof1 / 2)
