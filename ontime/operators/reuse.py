"""One input, several outputs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ontime.session import work_folder


@contextmanager
def cached(df: DataFrame, columns: Sequence[str] | None = None) -> Iterator[DataFrame]:
    """Keep a DataFrame for the duration of the block, only its named columns.

    Nothing prunes columns above a cache, so the choice has to be made below
    it. Blocks that do not fit in memory go to disk, and blocks lost with an
    executor are computed again.
    """
    kept = (df.select(*columns) if columns else df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Compute a DataFrame now and read it back from the shared folder, where its lineage ends."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
