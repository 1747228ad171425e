"""Row filters. Each is a plain predicate, so it reaches the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import lenient_flag


def carrier_filter(
    df: DataFrame, carriers: Sequence[str], carrier: str = S.CARRIER
) -> DataFrame:
    return df.filter(F.col(carrier).isin(list(carriers)))


def month_range(df: DataFrame, first: int, last: int, month: str = S.MONTH) -> DataFrame:
    """Months first..last; on a month-partitioned table this prunes directories."""
    return df.filter(F.col(month).between(first, last))


def operated_filter(df: DataFrame, cancelled: str = S.CANCELLED) -> DataFrame:
    """Flights that left: not cancelled, diverted ones included."""
    return df.filter(F.col(cancelled) == 0)


def completed_filter(
    df: DataFrame, cancelled: str = S.CANCELLED, diverted: str = S.DIVERTED
) -> DataFrame:
    """Flights that arrived as planned: neither cancelled nor diverted."""
    return df.filter(F.col(diverted) == 0).filter(F.col(cancelled) == 0)


def lenient_completed_filter(
    df: DataFrame,
    cancelled: str = S.CANCELLED,
    diverted: str = S.DIVERTED,
    carrier: str = S.CARRIER,
) -> DataFrame:
    """`completed_filter` for flags of doubtful quality, possibly held as text.

    A missing cancellation flag counts as flown, a missing diversion flag as
    diverted, a flag that is no number drops the row, as does a missing or
    empty carrier.
    """
    return df.filter(
        (lenient_flag(cancelled, if_null=0.0, if_unparsable=1.0) == 0)
        & (lenient_flag(diverted, if_null=1.0, if_unparsable=1.0) == 0)
        & F.col(carrier).isNotNull()
        & (F.col(carrier) != "")
    )


def lenient_operated_filter(
    df: DataFrame,
    carriers: Sequence[str],
    cancelled: str = S.CANCELLED,
    carrier: str = S.CARRIER,
) -> DataFrame:
    """`operated_filter` with the same tolerance, for the listed carriers."""
    return df.filter(
        (lenient_flag(cancelled, if_null=0.0, if_unparsable=1.0) == 0)
        & F.col(carrier).isin(list(carriers))
    )


def min_records(df: DataFrame, threshold: int, records: str = "records") -> DataFrame:
    """Keep groups with at least `threshold` records (a HAVING clause)."""
    return df.filter(F.col(records) >= threshold)
