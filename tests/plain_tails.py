"""Tail probabilities one by one, to compare the column expressions with."""

import math

_TINY = 1e-300
_EPS = 1e-16


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:  # power series of the lower part
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    b = x + 1 - a  # continued fraction of the upper part
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / ((step * d + b) or _TINY)
        c = (b + step / c) or _TINY
        h *= d * c
        if abs(d * c - 1) < _EPS * 10:
            break
    return h * scale


def beta_regularised(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_regularised(1 - x, b, a)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or _TINY)
    h = d
    for m in range(1, 10_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / ((1 + step * d) or _TINY)
            c = (1 + step / c) or _TINY
            h *= d * c
        if abs(d * c - 1) < _EPS * 10:
            break
    return front * h / a


def chi2_tail(statistic: float, df: float) -> float:
    return gamma_upper(df / 2, statistic / 2)


def f_tail(statistic: float, df1: float, df2: float) -> float:
    if statistic <= 0:
        return 1.0
    return beta_regularised(df2 / (df2 + df1 * statistic), df2 / 2, df1 / 2)


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))
