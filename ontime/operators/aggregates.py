"""Grouped metrics.

The `*_columns` functions return aggregate expressions, so that a report can
compute all of its metrics in one `groupBy`. Every aggregate used here has a
partial form: a task ships one row per group, however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import max_where, mean_where, min_where, rate_pct, round2


def conditional_columns(condition: Column, value: str, prefix: str) -> list[Column]:
    """Rounded mean, min and max over the rows that satisfy the condition."""
    return [
        round2(mean_where(condition, value)).alias(f"{prefix}_mean"),
        round2(min_where(condition, value)).alias(f"{prefix}_min"),
        round2(max_where(condition, value)).alias(f"{prefix}_max"),
    ]


def rate_column(flag: str, name: str) -> Column:
    return round2(rate_pct(F.sum(flag), F.count(F.lit(1)))).alias(name)


def mean_columns(means: Mapping[str, str]) -> list[Column]:
    """Rounded mean per column; `means` maps column to output name."""
    return [round2(F.avg(column)).alias(name) for column, name in means.items()]


def min_max_columns(value: str, prefix: str) -> list[Column]:
    return [
        round2(F.min(value)).alias(f"{prefix}_min"),
        round2(F.max(value)).alias(f"{prefix}_max"),
    ]


def cond_agg(
    df: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    condition: Column | None = None,
    prefix: str = "dep_delay",
) -> DataFrame:
    """Mean, min and max over flown flights; a group of cancelled ones stays, with NULLs."""
    if condition is None:
        condition = F.col(S.CANCELLED) == 0
    return df.groupBy(*keys).agg(*conditional_columns(condition, value, prefix))


def cancel_rate(
    df: DataFrame,
    keys: Sequence[str],
    flag: str = S.CANCELLED,
    name: str = "cancellation_rate",
) -> DataFrame:
    return df.groupBy(*keys).agg(rate_column(flag, name))


def group_count(df: DataFrame, keys: Sequence[str], name: str = "records") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def multi_mean(df: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*mean_columns(means))


def min_max(
    df: DataFrame,
    keys: Sequence[str],
    value: str = S.DEP_DELAY,
    prefix: str = "dep_delay",
) -> DataFrame:
    return df.groupBy(*keys).agg(*min_max_columns(value, prefix))
