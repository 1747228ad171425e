"""Rows of a result as plain dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame


def records(df: DataFrame) -> list[dict]:
    return [row.asDict() for row in df.collect()]
