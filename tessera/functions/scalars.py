"""Scalar cleaning and feature expressions (SCA12, SCA15-SCA24, SCA27, FLT9, NUL4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values of the reference's rules ----------------------------------
ROMAN = (("0", 0), ("I", 1), ("II", 2), ("III", 3), ("IV", 4), ("V", 5))
YES_NO = (("yes", 1), ("no", 0), ("y", 1), ("n", 0))
TUMOUR_BINS = (0, 2, 5, 10, 50, float("inf"))
DAYS_PER_YEAR = 365
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unit(c, unit: str) -> Column:
    """SCA15: '170cm' -> 170.0; not a number -> NULL."""
    return F.regexp_replace(_c(c), unit, "").try_cast("double")


def lenient_date(c, fmt: str) -> Column:
    """SCA16: text -> DATE with a given pattern; unparsable -> NULL."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))


def roman_to_int(c) -> Column:
    """SCA17: roman numeral (0, I .. V) -> int; unknown -> NULL."""
    m = F.create_map(*[F.lit(x) for kv in ROMAN for x in kv])
    return F.try_element_at(m, F.upper(F.trim(_c(c))))


def yes_no_to_int(c) -> Column:
    """SCA18: yes/no/y/n (any case) -> 1/0; other -> NULL."""
    m = F.create_map(*[F.lit(x) for kv in YES_NO for x in kv])
    return F.try_element_at(m, F.lower(F.trim(_c(c))))


def yes_no_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """SCA18 probe: the string columns whose non-null values are all yes/no words
    (one aggregate over all candidate columns)."""
    words = [w for w, _ in YES_NO]
    row = df.agg(*[F.bool_and(F.col(c).isNull() | F.lower(F.trim(F.col(c))).isin(*words)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def years_between(later, earlier) -> Column:
    """SCA19: whole years as days // 365."""
    return F.floor(F.datediff(_c(later), _c(earlier)) / DAYS_PER_YEAR).cast("int")


def right_closed_bin(c, edges=TUMOUR_BINS) -> Column:
    """SCA12: (e0, e1] -> 0 with e0 included, (e1, e2] -> 1, ...; outside -> NULL."""
    x = _c(c)
    expr = F.when((x >= edges[0]) & (x <= edges[1]), 0)
    for i in range(1, len(edges) - 1):
        expr = expr.when((x > edges[i]) & (x <= edges[i + 1]), i)
    return expr


def bmi(weight, height_cm) -> Column:
    """SCA20: weight / (height/100)^2; zero height -> NULL."""
    return F.try_divide(_c(weight), F.pow(_c(height_cm) / 100.0, 2))


def count_parts(c, sep: str = "+") -> Column:
    """SCA21: number of ``sep``-separated parts; NULL stays NULL (counts 0)."""
    return F.when(_c(c).isNull(), F.lit(0)).otherwise(F.size(F.split(_c(c), "\\" + sep)))


def positive_flag(c) -> Column:
    """SCA22: numeric coerce > 0 (text that is not a number -> 0)."""
    return F.coalesce((_c(c).try_cast("double") > 0).cast("int"), F.lit(0))


def clip(c, lo: float, hi: float) -> Column:
    """SCA23: np.clip."""
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def round_half_even(c, digits: int = 0) -> Column:
    """SCA23: NumPy rounding (half to even)."""
    return F.bround(_c(c), digits)


def interaction(a, b) -> Column:
    """SCA20: interaction product of two features (NULL if either is)."""
    return _c(a) * _c(b)


def softmax(c) -> Column:
    """SCA27: softmax over an array of logits (max-shifted); the maximum, the exponentials and their
    total are computed once a row."""
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    ex = once(F.struct(_c(c).alias("v"), F.array_max(_c(c)).alias("m")), lambda s: F.transform(s["v"], lambda v: F.exp(v - s["m"])))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return once(ex, lambda e: once(F.struct(e.alias("e"), total(e).alias("t")), lambda s: F.transform(s["e"], lambda v: v / s["t"])))


def argmax(c) -> Column:
    """SCA27: 0-based index of the largest element (first on ties)."""
    return (F.array_position(_c(c), F.array_max(_c(c))) - 1).cast("int")
