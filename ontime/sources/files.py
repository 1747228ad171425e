"""Raw flight records, the month-partitioned table, and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime import schema as S
from ontime.sources.delimited import scan_csv


def scan_raw(spark: SparkSession, path: str, fmt: str = "avro") -> DataFrame:
    """Raw records from a folder or glob, with the declared fields in their declared types.

    Columns beyond the declared ones are kept.
    """
    if fmt == "csv":
        return scan_csv(spark, path)
    return S.conform(spark.read.format(fmt).load(path), S.FLIGHT_SCHEMA)


def scan_avro(spark: SparkSession, path: str) -> DataFrame:
    """Raw Avro records; needs the `spark-avro` package on the classpath."""
    return scan_raw(spark, path, "avro")


def scan_partitioned(
    spark: SparkSession,
    root: str,
    months: tuple[int, int] | None = None,
    partition_col: str = S.MONTH,
    schema: T.StructType | None = S.FLIGHT_SCHEMA,
) -> DataFrame:
    """Clean records from directories `<partition_col>=<month>`.

    The month range is a filter on the partition column, so Spark lists and
    reads only those directories. With `schema=None` the columns come from the
    file footers, which keeps extra columns.
    """
    reader = spark.read
    if schema is not None:
        if partition_col not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(partition_col, T.IntegerType())])
        reader = reader.schema(schema)
    df = reader.parquet(root)
    if months is not None:
        df = df.filter(F.col(partition_col).between(*months))
    return df


def scan_csv_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A report written with a header; headings that differ from the schema fail."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
