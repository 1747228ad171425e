"""The three delay questions, with every choice an argument."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import hour_bucket, round2
from ontime.operators import aggregates as A
from ontime.operators import quantiles as Q
from ontime.operators import states
from ontime.operators.filters import (
    carrier_filter,
    completed_filter,
    min_records,
    month_range,
    operated_filter,
)
from ontime.operators.ranking import sorted_report, top_k

# What the studied reports ask for.
FIRST_MONTHS = (1, 4)
Q1_CARRIERS = ("AA", "DL")
Q3_CARRIERS = ("AA", "DL", "UA", "WN")

# Column -> output name of its mean in the carrier report.
Q2_MEANS = {S.ARR_DELAY: "arr_delay_mean"} | {c: f"{c.lower()}_mean" for c in S.CAUSES}


def q1_monthly_delay(
    df: DataFrame,
    carriers: Sequence[str] = Q1_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
) -> DataFrame:
    """Departure delay and cancellation rate by month and carrier."""
    flown = F.col(S.CANCELLED) == 0
    return (
        df.transform(month_range, *months)
        .transform(carrier_filter, carriers)
        .groupBy(F.col(S.MONTH).alias("month"), F.col(S.CARRIER).alias("carrier"))
        .agg(
            *A.conditional_columns(flown, S.DEP_DELAY, "dep_delay"),
            A.rate_column(S.CANCELLED, "cancellation_rate"),
        )
        .transform(sorted_report, ["month", "carrier"])
    )


def q2_carriers(
    df: DataFrame,
    months: tuple[int, int] = FIRST_MONTHS,
    threshold: int = 500,
) -> DataFrame:
    """Mean arrival delay and delay causes of every carrier with enough flights."""
    return (
        df.transform(month_range, *months)
        .transform(completed_filter)
        .groupBy(F.col(S.CARRIER).alias("carrier"))
        .agg(F.count(F.lit(1)).alias("records"), *A.mean_columns(Q2_MEANS))
        .transform(min_records, threshold)
    )


def q2_top_carriers(
    df: DataFrame,
    months: tuple[int, int] = FIRST_MONTHS,
    threshold: int = 500,
    k: int = 10,
) -> DataFrame:
    """The k carriers with the worst rounded mean arrival delay."""
    return q2_carriers(df, months, threshold).transform(
        top_k, "arr_delay_mean", k, "carrier"
    )


def monthly_state(df: DataFrame) -> DataFrame:
    """What q1 and q2 need of a month and carrier, from one scan of the flights."""
    completed = (F.col(S.CANCELLED) == 0) & (F.col(S.DIVERTED) == 0)
    return df.groupBy(S.MONTH, S.CARRIER).agg(
        *states.delay_state_columns(),
        *states.sum_state_columns(list(Q2_MEANS), completed),
    )


def q1_from_states(
    monthly: DataFrame,
    carriers: Sequence[str] = Q1_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
) -> DataFrame:
    """The monthly report from stored `monthly_state` rows, without a scan of flights."""
    wanted = monthly.transform(month_range, *months).transform(carrier_filter, carriers)
    merged = states.merge_delay_state(wanted, [S.MONTH, S.CARRIER])
    return (
        states.finalize_delay_state(merged, [S.MONTH, S.CARRIER])
        .withColumnsRenamed({S.MONTH: "month", S.CARRIER: "carrier"})
        .transform(sorted_report, ["month", "carrier"])
    )


def q2_from_states(
    monthly: DataFrame,
    months: tuple[int, int] = FIRST_MONTHS,
    threshold: int = 500,
    k: int = 10,
) -> DataFrame:
    """The carrier report from stored `monthly_state` rows."""
    merged = states.merge_sum_state(
        monthly.transform(month_range, *months), [S.CARRIER], list(Q2_MEANS)
    )
    return (
        states.finalize_sum_state(merged, [S.CARRIER], Q2_MEANS)
        .withColumnRenamed(S.CARRIER, "carrier")
        .transform(min_records, threshold)
        .transform(top_k, "arr_delay_mean", k, "carrier")
    )


def q3_input(
    df: DataFrame,
    carriers: Sequence[str] = Q3_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
) -> DataFrame:
    """Flown flights of the carriers: carrier, hour of scheduled departure, delay."""
    return (
        df.transform(month_range, *months)
        .transform(operated_filter)
        .transform(carrier_filter, carriers)
        .select(
            F.col(S.CARRIER).alias("carrier"),
            hour_bucket(S.SCHEDULED_DEPARTURE).alias("hour_bucket"),
            S.DEP_DELAY,
        )
    )


def q3_histogram(
    df: DataFrame,
    carriers: Sequence[str] = Q3_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
) -> DataFrame:
    """Flights per carrier, hour and delay: all that either q3 report needs."""
    return Q.value_histogram(q3_input(df, carriers, months), ["carrier", "hour_bucket"])


def monthly_delays(df: DataFrame) -> DataFrame:
    """Flown flights per month, carrier, hour and delay, to be stored and merged."""
    rows = operated_filter(df).withColumn("hour_bucket", hour_bucket(S.SCHEDULED_DEPARTURE))
    return Q.value_histogram(rows, [S.MONTH, S.CARRIER, "hour_bucket"])


def monthly_detail(df: DataFrame) -> DataFrame:
    """States per month, carrier, hour and delay, from one scan of the flights.

    Both state tables are made of it: `monthly_of` adds up hours and delays,
    `delays_of` takes the flown flights of each.
    """
    completed = (F.col(S.CANCELLED) == 0) & (F.col(S.DIVERTED) == 0)
    rows = df.withColumn("hour_bucket", hour_bucket(S.SCHEDULED_DEPARTURE))
    return rows.groupBy(S.MONTH, S.CARRIER, "hour_bucket", S.DEP_DELAY).agg(
        *states.delay_state_columns(),
        *states.sum_state_columns(list(Q2_MEANS), completed),
        F.count(F.when(F.col(S.CANCELLED) == 0, F.lit(1))).alias("n"),
    )


def monthly_of(detail: DataFrame) -> DataFrame:
    """The `monthly_state` from `monthly_detail` rows."""
    means = list(Q2_MEANS)
    return detail.groupBy(S.MONTH, S.CARRIER).agg(
        *states.merged_delay_columns(), *states.merged_sum_columns(means)
    )


def delays_of(detail: DataFrame) -> DataFrame:
    """The `monthly_delays` from `monthly_detail` rows."""
    flown = detail.where(F.col("n") > 0)
    return flown.select(S.MONTH, S.CARRIER, "hour_bucket", S.DEP_DELAY, "n")


def monthly_sketches(df: DataFrame, k: int = Q.SKETCH_K) -> DataFrame:
    """A KLL sketch, minimum and maximum of the delays of flown flights per month,
    carrier and hour. A stored row has a bounded size, whatever the values."""
    rows = operated_filter(df).withColumn("hour_bucket", hour_bucket(S.SCHEDULED_DEPARTURE))
    return rows.groupBy(S.MONTH, S.CARRIER, "hour_bucket").agg(
        Q.sketch_column(S.DEP_DELAY, k),
        F.min(S.DEP_DELAY).alias("dep_delay_min"),
        F.max(S.DEP_DELAY).alias("dep_delay_max"),
    )


def q3_sketches_from_states(
    sketches: DataFrame,
    carriers: Sequence[str] = Q3_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
    k: int = Q.SKETCH_K,
) -> DataFrame:
    """Stored `monthly_sketches` merged to carrier and hour."""
    wanted = sketches.transform(month_range, *months).transform(carrier_filter, carriers)
    return wanted.groupBy(F.col(S.CARRIER).alias("carrier"), "hour_bucket").agg(
        Q.merged_sketch_column(k),
        F.min("dep_delay_min").alias("dep_delay_min"),
        F.max("dep_delay_max").alias("dep_delay_max"),
    )


def q3_percentiles_from_sketches(merged: DataFrame) -> DataFrame:
    """The percentile report from merged sketches, within their rank error."""
    return _q3_rounded(Q.read_sketch(merged, ["carrier", "hour_bucket"]))


def q3_min_max_from_sketches(merged: DataFrame) -> DataFrame:
    """The min/max report, exact, from what is stored next to the sketches."""
    return (
        merged.groupBy("carrier")
        .agg(F.min("dep_delay_min").alias("dep_delay_min"), F.max("dep_delay_max").alias("dep_delay_max"))
        .transform(sorted_report, ["carrier"])
    )


def q3_histogram_from_states(
    delays: DataFrame,
    carriers: Sequence[str] = Q3_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
) -> DataFrame:
    """The `q3_histogram` from stored `monthly_delays` rows, without a scan of flights."""
    wanted = delays.transform(month_range, *months).transform(carrier_filter, carriers)
    return Q.merge_histogram(
        wanted.withColumnRenamed(S.CARRIER, "carrier"), ["carrier", "hour_bucket"]
    )


def _q3_rounded(percentiles: DataFrame) -> DataFrame:
    names = Q.QUARTILES_AND_P90_NAMES
    return percentiles.select(
        "carrier", "hour_bucket", *[round2(name).alias(name) for name in names]
    ).transform(sorted_report, ["carrier", "hour_bucket"])


def q3_percentiles(
    df: DataFrame,
    carriers: Sequence[str] = Q3_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
    method: Literal["discrete", "interpolated", "approx"] = "discrete",
    accuracy: int = 100,
) -> DataFrame:
    """Departure-delay percentiles by carrier and hour.

    `accuracy` matters for `approx` only.
    """
    rows = q3_input(df, carriers, months)
    keys = ["carrier", "hour_bucket"]
    if method == "approx":
        return _q3_rounded(Q.percentiles_approx(rows, keys, accuracy=accuracy))
    exact = {"discrete": Q.percentiles_discrete, "interpolated": Q.percentiles_interpolated}
    return _q3_rounded(exact[method](rows, keys))


def q3_percentiles_of(histogram: DataFrame, interpolate: bool = False) -> DataFrame:
    """The percentile report from a `q3_histogram`."""
    return _q3_rounded(
        Q.percentiles_from_histogram(
            histogram, ["carrier", "hour_bucket"], interpolate=interpolate
        )
    )


def q3_min_max(
    df: DataFrame,
    carriers: Sequence[str] = Q3_CARRIERS,
    months: tuple[int, int] = FIRST_MONTHS,
) -> DataFrame:
    """Smallest and largest departure delay by carrier."""
    return q3_min_max_of(q3_input(df, carriers, months))


def q3_min_max_of(rows: DataFrame) -> DataFrame:
    """The same from `q3_input` rows or from a `q3_histogram`."""
    return A.min_max(rows, ["carrier"]).transform(sorted_report, ["carrier"])
