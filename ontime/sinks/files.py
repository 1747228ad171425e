"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ontime import schema as S


def write_partitioned(
    df: DataFrame,
    root: str,
    partition_col: str = S.MONTH,
    cluster_by: Sequence[str] = (S.CARRIER,),
    rebalance: bool = True,
    replace: Literal["table", "touched"] = "table",
) -> str:
    """Overwrite a Parquet table with one directory per partition value.

    A dozen months would make a dozen writers under plain hash partitioning.
    The rebalance step lets AQE split a large month into files of the advisory
    size and merge small ones. Rows of one carrier lie together in a file, so
    a carrier filter skips row groups. `rebalance=False` writes without a
    shuffle, for input that arrives month by month. `replace="touched"`
    overwrites only the partitions that occur in `df`.
    """
    if rebalance:
        df = df.hint("rebalance", partition_col, *cluster_by)
    if cluster_by:
        df = df.sortWithinPartitions(partition_col, *cluster_by)
    mode = {"table": "static", "touched": "dynamic"}[replace]
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(partition_col)
        .parquet(root)
    )
    return root


def write_report_csv(df: DataFrame, path: str, single_file: bool = True) -> str:
    """Overwrite CSV with a header row.

    `single_file` is for result tables (a few rows per carrier and month).
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, header=True)
    return path


def noop_run(df: DataFrame) -> int:
    """Compute every row and discard it; returns how many there were."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode(
        "overwrite"
    ).save()
    return seen.get["rows"]
