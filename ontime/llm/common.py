"""What several of the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.session import remove_folder, work_folder

# Fixed values of the contract: a word is a run of characters other than these.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The most rows, or elements of the arrays in them, that any operator here
# broadcasts, after counting them.
BROADCAST_ROWS = 200_000


def materialise(spark: SparkSession, df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back: lineage ends there."""
    folder = work_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        remove_folder(spark, folder)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a counted, small table; otherwise Spark shuffles it."""
    return F.broadcast(df) if rows <= limit else df


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    bare = stripped(F.coalesce(text, F.lit("")))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, whatever `body` does with it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hash60(*parts: Column) -> Column:
    """A 60-bit hash that other SQL engines compute alike: the head of an MD5."""
    joined = F.concat_ws(":", *(F.coalesce(part.cast("string"), F.lit("\0")) for part in parts))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")
