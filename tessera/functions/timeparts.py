"""SCA7-SCA11, PRJ4: time parts and lenient timestamp parsing (right-closed bins: ``scalars``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso_timestamp(c) -> Column:
    """PRJ4: ISO-8601 text with 0-6 fraction digits and optional ``Z``.

    Pattern-free parse: a fixed ``.SSSX`` pattern cannot read 6 fraction
    digits, so no pattern is given; unparsable text gives NULL.
    """
    return F.try_to_timestamp(F.regexp_replace(_c(c), "Z$", ""))


def hour_of(c) -> Column:
    return F.hour(_c(c))


def weekday_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def minute_bucket(c) -> Column:
    return F.date_trunc("minute", _c(c))


def hhmm_to_hour(c) -> Column:
    """SCA10: 1435 -> 14."""
    return F.floor(_c(c) / 100).cast("int")


def left_closed_bins(c, edges, labels) -> Column:
    """SCA11: [e0,e1) -> labels[0] ... ; outside -> NULL (``pd.cut(right=False)``)."""
    x = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x >= lo) & (x < hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def calendar_features(date_col) -> dict[str, Column]:
    """SCA9: day of year, ISO week, quarter, weekend flag (Mon=0 .. Sun=6, weekend >= 5)."""
    d = _c(date_col)
    return {
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "quarter": F.quarter(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
    }
