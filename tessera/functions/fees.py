"""SCA1-SCA3, SCA5, SCA6: fee models, fee recommendation, segments, day parts.

All are native column expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's business rules ----------
FLAT_RATE = 0.02                   # flat model: 2 % of the amount
PROGRESSIVE_LOW_RATE = 0.015       # amount <= 1 000 000
PROGRESSIVE_HIGH_RATE = 0.03       # amount  > 1 000 000 (on the whole amount)
PROGRESSIVE_LIMIT = 1_000_000
TIERED_BASE_RATE = 0.02
TIERED_EXTRA_RATE = 0.005          # on the whole amount when above the limit
TIERED_LIMIT = 1_500_000
# simulated fee of the audit (SCA3)
SIM_FLAT_FEE = 20_000
SIM_PROG_RATE = 0.020
SIM_TIER_RATE_LOW = 0.015          # up to 1 000 000
SIM_TIER_RATE_HIGH = 0.010         # above 1 000 000
SIM_TIER_LIMIT = 1_000_000
# recommendation thresholds (SCA2)
REC_GOVERNMENT_LIMIT = 1_000_000
REC_FLAT_BELOW = 300_000
REC_PROGRESSIVE_BELOW = 1_500_000
# customer segments (SCA5)
POWER_USER_MIN_TXNS = 19           # strictly more than this
BIG_SPENDER_MIN_TOTAL = 22_000_000  # strictly more than this
# day parts (SCA6), inclusive hour ranges; anything else is night
DAY_PARTS = (("morning", 5, 11), ("afternoon", 12, 17), ("evening", 18, 23))
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flat_commission(amount) -> Column:
    return _c(amount).cast("double") * F.lit(FLAT_RATE)


def progressive_commission(amount) -> Column:
    a = _c(amount).cast("double")
    return F.when(a <= PROGRESSIVE_LIMIT, a * PROGRESSIVE_LOW_RATE).otherwise(a * PROGRESSIVE_HIGH_RATE)


def tiered_commission(amount) -> Column:
    a = _c(amount).cast("double")
    extra = F.when(a > TIERED_LIMIT, a * TIERED_EXTRA_RATE).otherwise(F.lit(0.0))
    return a * TIERED_BASE_RATE + extra


def recommend_commission(amount, category, customer_type) -> Column:
    a, cat, ct = _c(amount), _c(category), _c(customer_type)
    return (F.when(ct == "CIP", "flat")
            .when((cat == "government") & (a > REC_GOVERNMENT_LIMIT), "tiered")
            .when(a < REC_FLAT_BELOW, "flat")
            .when(a < REC_PROGRESSIVE_BELOW, "progressive")
            .otherwise("tiered"))


def simulate_fee(amount, fee_type) -> Column:
    a, t = _c(amount).cast("double"), _c(fee_type)
    tier = F.when(a <= SIM_TIER_LIMIT, a * SIM_TIER_RATE_LOW).otherwise(
        F.lit(SIM_TIER_LIMIT * SIM_TIER_RATE_LOW) + (a - SIM_TIER_LIMIT) * SIM_TIER_RATE_HIGH)
    return (F.when(t == "flat", F.lit(float(SIM_FLAT_FEE)))
            .when(t == "progressive", a * SIM_PROG_RATE)
            .otherwise(tier))


def customer_segment(n_txns, total) -> Column:
    return (F.when(_c(n_txns) > POWER_USER_MIN_TXNS, "power_user")
            .when(_c(total) > BIG_SPENDER_MIN_TOTAL, "big_spender")
            .otherwise("regular"))


def day_part(hour) -> Column:
    h = _c(hour)
    expr = None
    for name, lo, hi in DAY_PARTS:
        cond = h.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("night")
