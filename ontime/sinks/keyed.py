"""Keyed records `table:key -> fields`, as Parquet partitioned by a hash of the key.

An upsert reads the buckets that its batch touches, and no others, and
replaces them by dynamic partition overwrite; a replacement is a static one.
Spark moves files into place when the job commits, so a write that fails
before leaves the table as it was, and one that fails while committing can
run again: the same batch gives the same records. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions import composite_key
from ontime.operators.reuse import cached
from ontime.schema import require_columns

# Buckets of a new table. An upsert rewrites the buckets that it touches, so
# tables of many keys want many; a table keeps its number until replaced.
BUCKETS = 16
_BUCKETS, _BUCKET = "_buckets", "_bucket"


def _folder(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [status.getPath().toString() for status in system.globStatus(path) or []]


def _stored_buckets(spark: SparkSession, folder: str) -> int | None:
    """The number of buckets in the table's folder names, or None without a table."""
    names = _matching(spark, f"{folder}/{_BUCKETS}=*")
    return int(names[0].rsplit("=", 1)[1]) if names else None


def _read(spark: SparkSession, folder: str, paths: list[str]) -> DataFrame:
    reader = spark.read.option("mergeSchema", "true").option("basePath", folder)
    return reader.parquet(*paths)


def read_keyed(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The stored records, or None if there is no such table yet."""
    folder = _folder(root, table)
    if _stored_buckets(spark, folder) is None:
        return None
    return _read(spark, folder, [folder]).drop(_BUCKETS, _BUCKET)


def one_per_key(records: DataFrame, key: str = "key", order_by: str | None = None) -> DataFrame:
    """One record per key: of several, the last by `order_by`.

    Without an order, records of one key that differ end the job; equal ones
    are one. An aggregate instead of a window: a key with very many records
    shrinks to one row per task before the shuffle.
    """
    fields = [c for c in records.columns if c != key]
    if not fields:
        return records.distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in fields])
    if order_by is None:
        differ = F.raise_error(F.concat(F.lit("records that differ for key "), F.col(key)))
        chosen = F.when(F.min(whole).eqNullSafe(F.max(whole)), F.max(whole)).otherwise(
            differ.cast(records.select(whole.alias("_")).schema["_"].dataType)
        )
    else:
        chosen = F.max(F.struct(F.col(f"`{order_by}`").alias("_order"), whole.alias("_fields")))["_fields"]
    return records.groupBy(key).agg(chosen.alias("_fields")).select(
        key, *[F.col(f"_fields.`{c}`").alias(c) for c in fields]
    )


def _records(batch: DataFrame, table: str, key: str, order_by: str | None) -> DataFrame:
    require_columns(batch, [key] if order_by is None else [key, order_by])
    named = batch.withColumn(key, composite_key(F.lit(table), F.col(key)))
    return one_per_key(named, key, order_by).withColumnRenamed(key, "key")


def _in_buckets(records: DataFrame, buckets: int) -> DataFrame:
    return records.withColumns(
        {
            _BUCKETS: F.lit(buckets),
            _BUCKET: F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"),
        }
    )


def _write(records: DataFrame, folder: str, mode: str) -> str:
    """Files of the advisory size: AQE splits large buckets and gathers small ones."""
    (
        records.hint("rebalance", _BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(_BUCKETS, _BUCKET)
        .parquet(folder)
    )
    return folder


def keyed_upsert(
    batch: DataFrame,
    root: str,
    table: str,
    key: str = "key",
    order_by: str | None = None,
    buckets: int = BUCKETS,
) -> str:
    """Write records under their key: known keys get the new fields, others stay.

    Only the buckets of the batch are read and written. Of records of one key,
    `order_by` names the column by which the last one counts; without it,
    records that differ end the job.
    """
    spark, folder = batch.sparkSession, _folder(root, table)
    stored = _stored_buckets(spark, folder)
    with cached(_in_buckets(_records(batch, table, key, order_by), stored or buckets)) as fresh:
        if stored is None:
            return keyed_write_new(fresh, folder)
        # At most one small number per bucket comes to the driver.
        touched = {f"{_BUCKET}={row[0]}" for row in fresh.select(_BUCKET).distinct().collect()}
        every = _matching(spark, f"{folder}/{_BUCKETS}={stored}/{_BUCKET}=*")
        paths = [path for path in every if path.rsplit("/", 1)[1] in touched]
        merged = fresh
        if paths:
            others = _read(spark, folder, paths).join(fresh.select("key"), "key", "left_anti")
            merged = others.unionByName(fresh, allowMissingColumns=True)
        return _write(merged, folder, "dynamic") if touched else folder


def keyed_replace(
    batch: DataFrame,
    root: str,
    table: str,
    key: str = "key",
    order_by: str | None = None,
    buckets: int = BUCKETS,
) -> str:
    """Write records under their key; keys of earlier writes are gone."""
    records = _in_buckets(_records(batch, table, key, order_by), buckets)
    return keyed_write_new(records, _folder(root, table))


def keyed_write_new(records: DataFrame, folder: str) -> str:
    """A table of these records alone. Without any, an empty file keeps the columns."""
    _write(records, folder, "static")
    if _stored_buckets(records.sparkSession, folder) is None:
        empty = records.limit(0).drop(_BUCKETS, _BUCKET)
        empty.write.mode("overwrite").parquet(f"{folder}/{_BUCKETS}=1/{_BUCKET}=0")
    return folder


def write_keyed_connector(
    batch: DataFrame,
    table: str,
    fmt: str,
    mode: str = "append",
    key: str = "key",
    options: Mapping[str, str] | None = None,
) -> None:
    """Hand the records to a key-value connector that is on the classpath.

    Such connectors prefix the table name themselves; `append` keeps other
    keys, `overwrite` drops them.
    """
    require_columns(batch, [key])
    (
        batch.write.format(fmt)
        .options(**{"key.column": key, "table": table, **(options or {})})
        .mode(mode)
        .save()
    )
