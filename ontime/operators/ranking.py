"""Sorting, top-k and leaderboard positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.operators.reuse import stored


def sorted_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*keys)


def top_k(df: DataFrame, by: str, k: int, tie_break: str) -> DataFrame:
    """The k rows with the largest value; equal values in order of `tie_break`.

    Planned as a per-task top-k followed by a merge of k rows per task.
    """
    return df.orderBy(F.col(by).desc(), F.col(tie_break)).limit(k)


def leaderboard_rank(
    df: DataFrame, by: str, k: int, tie_break: str, name: str = "position"
) -> DataFrame:
    """Positions 1..k of the k largest values.

    The window has no partition; it runs after the top-k cut and sees k rows.
    """
    order = Window.orderBy(F.col(by).desc(), F.col(tie_break))
    return top_k(df, by, k, tie_break).withColumn(name, F.row_number().over(order))


def rank_all(
    df: DataFrame, by: str, tie_break: str, name: str = "position", partitions: int | None = None
) -> DataFrame:
    """Positions of all rows by falling value, equal values in order of `tie_break`.

    The rows are dealt to tasks by ranges of that order, each task numbers its
    own, and adds the number of rows in the ranges before: one row per range.
    The ranges are written once, since a second computation could cut them
    elsewhere.
    """
    order = [F.col(by).desc(), F.col(tie_break)]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    numbered = ranged.sortWithinPartitions(*order).select(
        "*",
        F.spark_partition_id().alias("_range"),
        # The low 33 bits count the rows of a partition.
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    kept = stored(numbered, "ranges")
    # One number per range comes to the driver and goes to the tasks.
    counts = dict(kept.groupBy("_range").count().collect())
    start, starts = 0, []
    for number in sorted(counts):
        starts.append(f"({number}, {start}L)")
        start += counts[number]
    listed = df.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(starts) or '(0, 0L)'} AS t(_at, _start)")
    position = (F.col("_start") + F.col("_row") + 1).cast("long").alias(name)
    return kept.join(F.broadcast(listed), F.col("_range") == F.col("_at")).select(
        *[F.col(f"`{c}`") for c in df.columns], position
    )
