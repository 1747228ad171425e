"""Column expressions: every one is built from Spark's own functions."""

from ontime.functions.columns import (
    composite_key,
    default_cast,
    hour_bucket,
    lenient_flag,
    mean_where,
    max_where,
    min_where,
    percentile_fields,
    rank_key,
    rate_pct,
    round2,
    strict_cast,
)

__all__ = [
    "composite_key",
    "default_cast",
    "hour_bucket",
    "lenient_flag",
    "max_where",
    "mean_where",
    "min_where",
    "percentile_fields",
    "rank_key",
    "rate_pct",
    "round2",
    "strict_cast",
]
