"""Column-expression helpers (JVM-side, codegen-friendly; no Python UDFs)."""

from churnscope.functions.columns import (
    is_return, elapsed_days, calendar_days, micros_between, safe_div,
    round_even, to_double, true_or_false, nan_free, units, sum_units, money,
)
from churnscope.functions.rules import (
    SEGMENT_ORDER, SEGMENT_VALUE_CODE, SEGMENT_RISK_LEVEL, SEGMENT_STRATEGY,
    ACTION_PLANS, RISK_TIERS, segment_of, quintile, risk_tier,
    segment_value_code, segment_risk_level,
)

__all__ = [
    "is_return", "elapsed_days", "calendar_days", "micros_between",
    "safe_div", "round_even", "to_double", "true_or_false", "nan_free", "units", "sum_units", "money",
    "SEGMENT_ORDER", "SEGMENT_VALUE_CODE", "SEGMENT_RISK_LEVEL",
    "SEGMENT_STRATEGY", "ACTION_PLANS", "RISK_TIERS", "segment_of",
    "quintile", "risk_tier", "segment_value_code", "segment_risk_level",
]
