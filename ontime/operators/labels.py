"""Column choice and naming of reports and records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.schema import require_columns


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, in the given order."""
    return require_columns(df, columns).select(*columns)


def report_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """The columns of a report under their headings, in the order of `labels`."""
    return require_columns(df, labels).select(
        *[F.col(name).alias(label) for name, label in labels.items()]
    )


def canonical_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Headings back to field names; a heading that is not there is an error."""
    return require_columns(df, names).withColumnsRenamed(dict(names))
