"""Tail probabilities as log10, so that strong evidence in large data does not end as zero.

They are applied on the driver to results with one row per test, never to data rows.
"""

from __future__ import annotations

import math

LN10 = math.log(10.0)


def _log_erfc(z: float) -> float:
    """log of the complementary error function for z >= 0."""
    if z < 25.0:
        return math.log(math.erfc(z))
    # Asymptotic series; at z >= 25 the next term is below 1e-11.
    u = 1.0 / (2.0 * z * z)
    return -z * z - math.log(z * math.sqrt(math.pi)) + math.log1p(-u + 3.0 * u * u - 15.0 * u**3)


def _log_sum(logs: list[float]) -> float:
    top = max(logs)
    return top + math.log(sum(math.exp(x - top) for x in logs))


def normal_log10_p(z: float) -> float:
    """log10 of P(|Z| >= |z|)."""
    return _log_erfc(abs(z) / math.sqrt(2.0)) / LN10


def chi_square_log10_p(x: float, df: int) -> float:
    """log10 of P(X >= x) for whole degrees of freedom, by the finite sum of the gamma tail."""
    y = x / 2.0
    if df <= 0:
        return math.nan
    if y <= 0:
        return 0.0
    logs, power = ([], 0.0) if df % 2 == 0 else ([_log_erfc(math.sqrt(y))], 0.5)
    while power < df / 2.0:
        logs.append(power * math.log(y) - y - math.lgamma(power + 1.0))
        power += 1.0
    return min(_log_sum(logs) / LN10, 0.0)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the front."""
    tiny = 1e-300
    numer, denom = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1.0)) or tiny)
    value = denom
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            denom = 1.0 / ((1.0 + step * denom) or tiny)
            numer = (1.0 + step / numer) or tiny
            value *= denom * numer
        if abs(denom * numer - 1.0) < 1e-15:
            break
    return value


def student_log10_p(t: float, df: float) -> float:
    """log10 of P(|T| >= |t|), from the incomplete beta function at df / (df + t^2)."""
    if t == 0.0:
        return 0.0
    a, b, x = df / 2.0, 0.5, df / (df + t * t)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        - a * math.log1p(t * t / df) + b * math.log(t * t / (df + t * t))
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return (log_front + math.log(_beta_fraction(a, b, x) / a)) / LN10
    return math.log10(1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b)
