"""Tail probabilities as column expressions (STT4, STT7, STT9): any number of groups gets its p-values
on the executors, without a row at the driver.

The regularised incomplete beta is its continued fraction, evaluated from its far end by
``aggregate``; the normal tail is its fraction beyond two standard deviations and
its series below.  A null argument gives null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 8
#: Terms of the normal tail's fraction and series.
_TERMS = 120


def _bound(value: Column, f) -> Column:
    """``f(value)`` with the value computed once a row."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def ln_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series at x + 8."""
    y = x + _SHIFT
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    shift = x
    for i in range(1, _SHIFT):
        shift = shift * (x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(shift)


def beta_inc(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta I_x(a, b) for a, b > 0."""
    a, b, x = (c.cast("double") for c in (a, b, x))
    near = x < (a + 1) / (a + b + 2)  # here the fraction converges fast; else that of the other tail does
    args = F.struct(F.when(near, a).otherwise(b).alias("a"), F.when(near, b).otherwise(a).alias("b"),
                    F.when(near, x).otherwise(1 - x).alias("x"), near.alias("near"))

    def tail(s: Column) -> Column:
        a, b, x = s["a"], s["b"], s["x"]
        depth = (64 + F.least(3 * F.sqrt(F.greatest(a, b)), F.lit(20_000.0))).cast("int")

        def step(rest: Column, m: Column) -> Column:
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            return 1 + even / (1 + odd / rest)

        rest = F.aggregate(F.sequence(depth, F.lit(1), F.lit(-1)), F.lit(1.0), step)
        front = F.exp(ln_gamma(a + b) - ln_gamma(a) - ln_gamma(b) + a * F.log(x) + b * F.log1p(-x))
        value = front / (1 - (a + b) * x / (a + 1) / rest) / a
        return F.when(s["near"], value).otherwise(1 - value)

    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(_bound(args, tail))


def t_sf(t: Column, df: Column) -> Column:
    """P(T > t) for Student t with ``df`` degrees of freedom."""
    def tail(s: Column) -> Column:
        t, df = s["t"], s["df"]
        half = 0.5 * beta_inc(df / 2, F.lit(0.5), df / (df + t * t))
        return F.when(t >= 0, half).otherwise(1 - half)

    return F.when(t.isNotNull() & df.isNotNull(), _bound(F.struct(t.cast("double").alias("t"), df.cast("double").alias("df")), tail))


def f_sf(f: Column, d1: Column, d2: Column) -> Column:
    """P(F > f) for the F distribution."""
    def tail(s: Column) -> Column:
        return F.when(s["f"] <= 0, 1.0).otherwise(beta_inc(s["d2"] / 2, s["d1"] / 2, s["d2"] / (s["d2"] + s["d1"] * s["f"])))

    return _bound(F.struct(*[c.cast("double").alias(n) for c, n in ((f, "f"), (d1, "d1"), (d2, "d2"))]), tail)


def norm_sf(z: Column) -> Column:
    """P(Z > z) for the standard normal distribution."""
    def tail(s: Column) -> Column:
        z, x = s["z"], s["x"]
        density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
        fraction = F.aggregate(F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1)), x, lambda rest, m: x + m / rest)
        series = F.aggregate(F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1)), F.lit(1.0), lambda rest, m: 1 + rest * x * x / (2 * m + 1))
        upper = F.when(x > 2, density / fraction).otherwise(0.5 - density * x * series)
        return F.when(z >= 0, upper).otherwise(1 - upper)

    z = z.cast("double")
    return F.when(z.isNotNull(), _bound(F.struct(z.alias("z"), F.abs(z).alias("x")), tail))
