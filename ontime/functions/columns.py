"""Scalar and aggregate column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_bucket(hhmm: Column | str) -> Column:
    """Hour of an `hhmm` clock number; 2400 stays in a bucket of its own."""
    return (as_column(hhmm) / 100).cast("int")


def strict_cast(c: Column | str) -> Column:
    """To double; the job fails on a null or on text that is no number."""
    failure = F.raise_error(F.lit("missing value, or text that is no number"))
    return F.coalesce(as_column(c).cast("double"), failure.cast("double"))


def default_cast(c: Column | str, default: float = 0.0) -> Column:
    """To double with nulls replaced; text that is no number still fails."""
    c = as_column(c)
    return F.when(c.isNull(), F.lit(default)).otherwise(strict_cast(c))


def lenient_flag(c: Column | str, if_null: float, if_unparsable: float) -> Column:
    """To double, with one stand-in for null and another for bad text."""
    c = as_column(c)
    return F.when(c.isNull(), F.lit(if_null)).otherwise(
        F.coalesce(c.try_cast("double"), F.lit(if_unparsable))
    )


def round2(c: Column | str) -> Column:
    return F.round(as_column(c), 2)


def rate_pct(part: Column | str, whole: Column | str) -> Column:
    """Share in percent; NULL when there is nothing to take a share of."""
    return as_column(part) / F.nullif(as_column(whole), F.lit(0)) * 100


def mean_where(condition: Column, c: Column | str) -> Column:
    return F.avg(F.when(condition, as_column(c)))


def min_where(condition: Column, c: Column | str) -> Column:
    return F.min(F.when(condition, as_column(c)))


def max_where(condition: Column, c: Column | str) -> Column:
    return F.max(F.when(condition, as_column(c)))


def percentile_fields(array: Column | str, names: Sequence[str]) -> list[Column]:
    """One double column per element of a quantile array, as it is."""
    array = as_column(array)
    return [array.getItem(i).cast("double").alias(name) for i, name in enumerate(names)]


def composite_key(*parts: Column | str) -> Column:
    """Key parts joined with `:`. A null part fails instead of shortening the key."""
    missing = F.raise_error(F.lit("null part in a record key")).cast("string")
    return F.concat_ws(":", *[F.coalesce(as_column(p).cast("string"), missing) for p in parts])


def rank_key(position: Column | str) -> Column:
    return as_column(position).cast("string")
