from saldora.functions.expr import (
    AGE_BAND, AGE_GROUP, RECENCY, Band, band, days_since, difference, indicator,
    key_hash, missing_flag, round_to, safe_asinh,
)
from saldora.functions.metrics import METRICS, metric

__all__ = [
    "AGE_BAND", "AGE_GROUP", "RECENCY", "Band", "band", "days_since", "difference",
    "indicator", "key_hash", "missing_flag", "round_to", "safe_asinh", "METRICS", "metric",
]
