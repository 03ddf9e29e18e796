"""CDFs for p-values, evaluated on the driver over a handful of aggregates.

SciPy is not assumed: the regularised incomplete beta is its continued
fraction, the normal CDF uses ``math.erfc``.
"""

from __future__ import annotations

import math


def _fraction(a: float, b: float, x: float, depth: int) -> float:
    """1 / (1 + d1 / (1 + d2 / (1 + ...))) cut after ``depth`` pairs of terms, from its far end, with
    d(2m) = m (b - m) x / ((a + 2m - 1)(a + 2m)) and
    d(2m+1) = -(a + m)(a + b + m) x / ((a + 2m)(a + 2m + 1))."""
    tail = 1.0
    for m in range(depth, 0, -1):
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        tail = 1.0 + even / (1.0 + odd / tail)
    return 1.0 / (1.0 - (a + b) * x / (a + 1) / tail)


def _converged_fraction(a: float, b: float, x: float) -> float:
    """The fraction at twice the depth until it no longer changes."""
    depth, last = 16, math.inf
    while depth <= 1 << 16:
        value = _fraction(a, b, x, depth)
        if abs(value - last) <= 1e-14 * abs(value):
            return value
        depth, last = 2 * depth, value
    raise ArithmeticError(f"the incomplete beta function did not converge for {a}, {b}, {x}")


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(lbeta)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _converged_fraction(a, b, x) / a
    return 1.0 - front * _converged_fraction(b, a, 1.0 - x) / b


def t_sf(t: float, df: float) -> float:
    """P(T > t) for Student t with ``df`` degrees of freedom."""
    x = df / (df + t * t)
    tail = 0.5 * betainc(df / 2.0, 0.5, x)
    return tail if t >= 0 else 1.0 - tail


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution."""
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))
