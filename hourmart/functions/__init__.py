"""Column functions shared by the jobs."""

from hourmart.functions.pages import (
    funnel_score,
    is_product_like,
    is_product_prefix,
    leads_to_purchase,
)
from hourmart.functions.timebuckets import (
    as_hour,
    bucket,
    in_range,
    parse_timestamp,
    plain_timestamp,
    round_to_second,
    within,
)

__all__ = [
    "as_hour",
    "bucket",
    "funnel_score",
    "in_range",
    "is_product_like",
    "is_product_prefix",
    "leads_to_purchase",
    "parse_timestamp",
    "plain_timestamp",
    "round_to_second",
    "within",
]
