"""Cleaning rules for raw flight records. All of them are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime import schema as S


def require_fields(df: DataFrame, fields: Sequence[str] = S.REQUIRED_FIELDS) -> DataFrame:
    """Drop rows in which any of the fields is null.

    Spelled as `IS NOT NULL` terms, which Parquet evaluates on row group
    statistics and Catalyst simplifies; a count of non-nulls (`dropna`) allows
    neither.
    """
    present = [F.col(field).isNotNull() for field in fields]
    return S.require_columns(df, fields).filter(reduce(and_, present))


def explained_null(df: DataFrame, value: str, flags: Sequence[str]) -> DataFrame:
    """Keep a row whose value is present, or missing with one of the flags set."""
    excuses = [F.col(flag) == 1 for flag in flags]
    return df.filter(reduce(or_, excuses, F.col(value).isNotNull()))


def normalize_causes(
    df: DataFrame,
    causes: Sequence[str] = S.CAUSES,
    delay: str = S.ARR_DELAY,
    threshold: float = 15,
) -> DataFrame:
    """Zero the causes of a delay below the threshold and fill missing ones with 0.

    A flight without an arrival delay keeps the causes it reports.
    """
    short = F.col(delay) < threshold
    return df.withColumns(
        {
            cause: F.when(short, F.lit(0.0)).otherwise(F.coalesce(F.col(cause), F.lit(0.0)))
            for cause in causes
        }
    )


def clean_flights(df: DataFrame) -> DataFrame:
    """All rules in order; the result satisfies the invariants of a clean record."""
    return (
        df.transform(require_fields)
        .transform(explained_null, S.ARR_DELAY, [S.CANCELLED, S.DIVERTED])
        .transform(explained_null, S.DEP_DELAY, [S.CANCELLED])
        .transform(normalize_causes)
    )
