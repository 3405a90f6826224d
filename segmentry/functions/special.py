"""Tail probabilities of the chi-square, F and normal distributions as column expressions.

The series and continued fractions are folded over a sequence of steps whose length follows from the parameters; a fold
that has converged carries its value on. No row leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300
_EPS = 1e-15


def _let(then: Callable[..., Column], *values: Column) -> Column:
    """`then` of values that are computed once, however often it names them."""
    bound = F.array(F.struct(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)]))
    return F.get(F.transform(bound, lambda r: then(*[r[f"v{i}"] for i in range(len(values))])), F.lit(0))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for positive values: Stirling's series eight steps further up."""
    return _let(_stirling, x, x + 8)


def _stirling(x: Column, y: Column) -> Column:
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    square = y * y
    # Coefficients of Stirling's series, 1/12, -1/360, 1/1260, -1/1680, 1/1188, -691/360360.
    series = 1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - (1 / 1188 - 691 / 360360 / square) / square) / square) / square) / square
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series / y - F.ln(product)


def _steps(a: Column, base: int, per_root: int) -> Column:
    """0, 1, 2, … up to a bound that grows with the root of a parameter, as the number of steps to convergence does."""
    return F.sequence(F.lit(1), (F.lit(base) + F.ceil(F.sqrt(a)) * per_root).cast("int"))


def _nonzero(x: Column) -> Column:
    return F.when(x == 0, F.lit(_TINY)).otherwise(x)


def _lower_series(a: Column, x: Column) -> Column:
    """Sum of x^n / (a (a+1) … (a+n))."""
    start = F.struct((1 / a).alias("term"), (1 / a).alias("total"))

    def step(s, i):
        term = F.when(s["term"] > s["total"] * _EPS, s["term"] * x / (a + i)).otherwise(F.lit(0.0))
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    return F.aggregate(_steps(F.greatest(a, x), 100, 20), start, step, lambda s: s["total"])


def _upper_fraction(a: Column, x: Column) -> Column:
    """Lentz's continued fraction of the upper incomplete gamma function."""
    first = x + 1 - a
    start = F.struct(F.lit(1 / _TINY).alias("c"), (1 / first).alias("d"), (1 / first).alias("h"), F.lit(False).alias("done"))

    def step(s, i):
        part, b = -i * (i - a), first + 2 * i
        d = 1 / _nonzero(part * s["d"] + b)
        c = _nonzero(b + part / s["c"])
        return F.when(s["done"], s).otherwise(
            F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"), (F.abs(d * c - 1) < _EPS).alias("done"))
        )

    return F.aggregate(_steps(a, 200, 20), start, step, lambda s: s["h"])


def gamma_upper(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x)."""
    return _let(_gamma_upper, a, x)


def _gamma_upper(a: Column, x: Column) -> Column:
    scale = F.exp(a * F.ln(x) - x - log_gamma(a))
    is_low = x < a + 1
    low = F.greatest(1 - _lower_series(a, x) * scale, F.lit(0.0))
    return F.when(x.isNull() | a.isNull(), F.lit(None).cast("double")).when(x <= 0, 1.0).when(is_low, low).otherwise(_upper_fraction(a, x) * scale)


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    first = 1 / _nonzero(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"), F.lit(False).alias("done"))

    def step(s, m):
        c, d, h = s["c"], s["d"], s["h"]
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for part in (even, odd):
            d = 1 / _nonzero(1 + part * d)
            c = _nonzero(1 + part / c)
            h = h * d * c
        return F.when(s["done"], s).otherwise(
            F.struct(c.alias("c"), d.alias("d"), h.alias("h"), (F.abs(d * c - 1) < _EPS).alias("done"))
        )

    return F.aggregate(_steps(F.greatest(a, b), 60, 4), start, step, lambda s: s["h"])


def beta_regularised(x: Column, y: Column, a: Column, b: Column) -> Column:
    """Regularised incomplete beta I_x(a, b), with y = 1 - x given apart so that no digits are lost."""
    return _let(_beta_side, x, y, a, b, (x > (a + 1) / (a + b + 2)).cast("int"))


def _beta_side(x: Column, y: Column, a: Column, b: Column, far: Column) -> Column:
    """The fraction converges on the near side of the mean; the far side is its complement."""
    is_far = far == 1
    sides = F.when(is_far, y).otherwise(x), F.when(is_far, x).otherwise(y), F.when(is_far, b).otherwise(a), F.when(is_far, a).otherwise(b)

    def near(u, v, p, q):
        front = F.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * F.ln(u) + q * F.ln(v))
        return front * _beta_fraction(u, p, q) / p

    def ended(value):
        known = x.isNotNull() & a.isNotNull() & b.isNotNull()
        return F.when(known & (x <= 0), 0.0).when(known & (y <= 0), 1.0).when(known, F.when(is_far, 1 - value).otherwise(value))

    return ended(_let(near, *sides))


def chi2_p(statistic: Column, df: Column) -> Column:
    return gamma_upper(df / 2, statistic / 2)


def f_p(statistic: Column, df1: Column, df2: Column) -> Column:
    return _let(_f_tail, statistic, df1, df2)


def _f_tail(statistic: Column, df1: Column, df2: Column) -> Column:
    scale = df2 + df1 * statistic
    inner = beta_regularised(df2 / scale, df1 * statistic / scale, df2 / 2, df1 / 2)
    return F.when(statistic <= 0, 1.0).when(statistic == float("inf"), 0.0).otherwise(inner)


def normal_p(z: Column) -> Column:
    """Upper tail of the standard normal distribution."""
    half = gamma_upper(F.lit(0.5), z * z / 2) / 2
    return F.when(z == float("inf"), 0.0).when(z == -float("inf"), 1.0).when(z >= 0, half).otherwise(1 - half)
