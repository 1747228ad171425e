"""Partial results that can be stored and merged to coarser groups.

A state table holds one row per fine group (say month and carrier). Reports
come from merging states, so a new month costs one scan of that month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import max_where, min_where, rate_pct, round2

# How each state column of the two kinds of state combines.
DELAY_STATE = {
    "flights": F.sum,
    "cancelled": F.sum,
    "delay_count": F.sum,
    "delay_sum": F.sum,
    "delay_min": F.min,
    "delay_max": F.max,
}


def delay_state_columns(value: str = S.DEP_DELAY, cancelled: str = S.CANCELLED) -> list[Column]:
    flown = F.col(cancelled) == 0
    return [
        F.count(F.lit(1)).alias("flights"),
        F.count(F.when(F.col(cancelled) == 1, F.lit(1))).alias("cancelled"),
        F.count(F.when(flown, F.col(value))).alias("delay_count"),
        F.sum(F.when(flown, F.col(value))).alias("delay_sum"),
        min_where(flown, value).alias("delay_min"),
        max_where(flown, value).alias("delay_max"),
    ]


def sum_state_columns(columns: Sequence[str], condition: Column | None = None) -> list[Column]:
    """Records, and per column its values and their sum, over the rows that
    satisfy the condition if there is one."""

    def chosen(c: Column) -> Column:
        return c if condition is None else F.when(condition, c)

    return [
        F.count(chosen(F.lit(1))).alias("records"),
        *[F.count(chosen(F.col(c))).alias(f"{c.lower()}_count") for c in columns],
        *[F.sum(chosen(F.col(c))).alias(f"{c.lower()}_sum") for c in columns],
    ]


def delay_state(
    df: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    cancelled: str = S.CANCELLED,
) -> DataFrame:
    """Flights, cancelled flights, and count, sum, min and max of the delays of flown ones."""
    return df.groupBy(*keys).agg(*delay_state_columns(value, cancelled))


def merged_delay_columns() -> list[Column]:
    return [combine(column).alias(column) for column, combine in DELAY_STATE.items()]


def merged_sum_columns(columns: Sequence[str]) -> list[Column]:
    parts = [f"{c.lower()}_{part}" for part in ("count", "sum") for c in columns]
    return [F.sum(name).alias(name) for name in ("records", *parts)]


def merge_delay_state(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys).agg(*merged_delay_columns())


def finalize_delay_state(
    states: DataFrame, keys: Sequence[str], prefix: str = "dep_delay"
) -> DataFrame:
    """Means and rate out of states; NULL, not an error, if there is no delay."""
    present = F.nullif(F.col("delay_count"), F.lit(0))
    return states.select(
        *keys,
        round2(F.col("delay_sum") / present).alias(f"{prefix}_mean"),
        round2("delay_min").alias(f"{prefix}_min"),
        round2("delay_max").alias(f"{prefix}_max"),
        round2(rate_pct("cancelled", "flights")).alias("cancellation_rate"),
    )


def sum_state(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Number of records, and of each column the number of its values and their sum."""
    return df.groupBy(*keys).agg(*sum_state_columns(columns))


def merge_sum_state(
    states: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    return states.groupBy(*keys).agg(*merged_sum_columns(columns))


def finalize_sum_state(
    states: DataFrame, keys: Sequence[str], means: Mapping[str, str]
) -> DataFrame:
    """`means` maps summed column to output name. Nulls do not count in a mean."""

    def mean(c: str) -> Column:
        return F.col(f"{c.lower()}_sum") / F.nullif(F.col(f"{c.lower()}_count"), F.lit(0))

    return states.select(
        *keys,
        "records",
        *[round2(mean(c)).alias(name) for c, name in means.items()],
    )
