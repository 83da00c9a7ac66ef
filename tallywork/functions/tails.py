"""Tail probabilities for the test results.

Spark SQL has no incomplete beta or gamma function. These helpers run on the *result* table
only (one row per test); every statistic they receive is a Spark aggregate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300
_EPS = 1e-15
# A fraction that has not settled after so many terms is an error, not a result.
_MAX_TERMS = 20_000_000
# Double-exponential nodes and weights on (-1, 1).
_STEPS = np.arange(-100, 101) * 0.035
_NODES = np.tanh(np.pi / 2 * np.sinh(_STEPS))
_WEIGHTS = 0.035 * np.pi / 2 * np.cosh(_STEPS) / np.cosh(np.pi / 2 * np.sinh(_STEPS)) ** 2
_FAR = 700.0  # an integrand below exp(-700) of its largest value adds nothing


def _fraction(terms) -> float:
    """a1/(b1 + a2/(b2 + ...)) from an iterator of (a, b) pairs, by the modified Lentz method."""
    value = c = _TINY
    d = 0.0
    for a, b in terms:
        d = b + a * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + a / c
        c = c if abs(c) > _TINY else _TINY
        value *= c * d
        if abs(c * d - 1.0) < _EPS:
            return value
    raise ArithmeticError("the continued fraction did not converge")


def _gamma_terms(s: float, x: float):
    yield 1.0, x + 1.0 - s
    for i in range(1, _MAX_TERMS):
        yield -i * (i - s), x + 1.0 - s + 2.0 * i


def log_gamma_half_step(a: float) -> float:
    """log of Gamma(a + 1/2) / Gamma(a), without the cancellation of two large logarithms."""
    shift = 0.0
    while a < 20.0:
        shift -= math.log1p(0.5 / a)
        a += 1.0
    r = 1.0 / (a * a)
    return shift + 0.5 * math.log(a) - (1 / 8 - r * (1 / 192 - r * (1 / 640 - r * 17 / 14336))) / a


def upper_gamma(s: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(s, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x >= s + 1.0:
        return min(1.0, front * _fraction(_gamma_terms(s, x)))
    term = total = 1.0 / s
    k = s
    while abs(term) > abs(total) * _EPS:
        k += 1.0
        term *= x / k
        total += term
    return max(0.0, 1.0 - front * total)


def log_upper_gamma(s: float, x: float) -> float:
    """log of Q(s, x), also where Q is too small for a double."""
    if x >= s + 1.0:
        return min(0.0, s * math.log(x) - x - math.lgamma(s) + math.log(_fraction(_gamma_terms(s, x))))
    q = upper_gamma(s, x)
    return math.log(q) if q > 0.0 else -math.inf


def t_tail(t: float, dof: float) -> float:
    """Two-sided Student t tail, by one quadrature for any degrees of freedom of at least 1."""
    log_p = log_t_tail(t, dof)
    return log_p if math.isnan(log_p) else math.exp(log_p)


def log_t_tail(t: float, dof: float) -> float:
    """log of the two-sided Student t tail, also where the tail is too small for a double."""
    if t is None or dof is None or math.isnan(t) or math.isnan(dof):
        return math.nan
    if t == 0.0 or math.isinf(t):
        return 0.0 if t == 0.0 else -math.inf
    # With x = sqrt(dof) tan(angle) the density is a power of the cosine over a finite range.
    start = math.atan2(abs(t), math.sqrt(dof))

    def height(angle):
        square = np.sin(angle) ** 2  # the logarithm of the cosine, exact for small and for large angles
        return (dof - 1.0) * np.where(square < 0.5, 0.5 * np.log1p(-np.minimum(square, 0.5)), np.log(np.maximum(np.cos(angle), 1e-300)))

    low, high = start, math.pi / 2
    if dof > 1.0 and height(start) - height(high) > _FAR:
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if height(start) - height(middle) < _FAR else (low, middle)
    half = (high - start) / 2
    # the largest height stands outside the sum, so nothing underflows
    top = float(height(start))
    area = half * float(np.sum(_WEIGHTS * np.exp(height(start + half * (1.0 + _NODES)) - top)))
    return min(0.0, math.log(2.0 * area) + top + log_gamma_half_step(dof / 2.0) - 0.5 * math.log(math.pi))


def chi2_tail(x: float, dof: float) -> float:
    """Upper chi-square tail; a table without degrees of freedom gives 1."""
    if x is None or dof is None or math.isnan(x) or math.isnan(dof):
        return math.nan
    return 1.0 if dof <= 0 else upper_gamma(dof / 2.0, x / 2.0)


def log_chi2_tail(x: float, dof: float) -> float:
    """log of the upper chi-square tail; a table without degrees of freedom gives 0."""
    if x is None or dof is None or math.isnan(x) or math.isnan(dof):
        return math.nan
    return 0.0 if dof <= 0 or x <= 0.0 else log_upper_gamma(dof / 2.0, x / 2.0)


def _pairwise(function):
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([function(a, b) for a, b in zip(left, right)], dtype="float64")

    run.__annotations__ = {"left": pd.Series, "right": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")


def student_t_p_value(t: Column, dof: Column) -> Column:
    """Two-sided p-value of a t statistic; NULL when the statistic is NULL."""
    p = _pairwise(t_tail)(t.cast("double"), dof.cast("double"))
    return F.when(t.isNotNull() & dof.isNotNull(), p)


def chi_square_p_value(x: Column, dof: Column) -> Column:
    """Upper-tail p-value of a chi-square statistic; NULL when the statistic is NULL."""
    p = _pairwise(chi2_tail)(x.cast("double"), dof.cast("double"))
    return F.when(x.isNotNull() & dof.isNotNull(), p)


def student_t_log_p_value(t: Column, dof: Column) -> Column:
    """Natural logarithm of the two-sided p-value, which ranks tests whose p-value is 0 in double precision."""
    log_p = _pairwise(log_t_tail)(t.cast("double"), dof.cast("double"))
    return F.when(t.isNotNull() & dof.isNotNull(), log_p)


def chi_square_log_p_value(x: Column, dof: Column) -> Column:
    """Natural logarithm of the upper-tail p-value of a chi-square statistic."""
    log_p = _pairwise(log_chi2_tail)(x.cast("double"), dof.cast("double"))
    return F.when(x.isNotNull() & dof.isNotNull(), log_p)
