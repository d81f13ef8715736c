from tableops.functions.columns import (
    age_band,
    discount_level,
    first_match,
    payment_flag,
    profit_margin,
    revenue,
    revenue_tier,
    to_date_or_null,
)
from tableops.functions.metrics import metric

__all__ = [
    "age_band",
    "discount_level",
    "first_match",
    "metric",
    "payment_flag",
    "profit_margin",
    "revenue",
    "revenue_tier",
    "to_date_or_null",
]
