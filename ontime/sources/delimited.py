"""Delimited raw records: files with headers of their own, read whole or as they arrive."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Literal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime import schema as S

# Holds the original line of a record that does not parse.
BAD_RECORD = "_bad_record"
# Column of ingested records that tells the batch which brought them.
BATCH = "ingest_batch"
# Files of which one batch of an incremental run takes the names to the driver.
FILES_PER_BATCH = 10_000

BadRows = Literal["fail", "mark"]
FIRST_LINE = "path string, line string"


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file's first part; what follows is not read."""
    for batch in batches:
        if batch.num_rows:
            if batch.column(2)[0].as_py() == 0:
                yield batch.slice(0, 1).select([0, 1])
            return


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line of each file, by its path; files without a line are left out.

    Each file is a task of its own that stops after a line. The driver gets as
    many short lines as it has file names already.
    """
    # Settings of this read alone: an opened file counts as a full partition,
    # and a line is handed on as soon as it is there.
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.openCostInBytes", reader.conf.get("spark.sql.files.maxPartitionBytes"))
    reader.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = reader.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    return dict(lines.mapInArrow(_first_line, FIRST_LINE).collect())


def _declared(header: Sequence[str], known: dict[str, T.DataType], path: str) -> T.StructType:
    missing = [name for name in known if name not in header]
    if missing:
        raise ValueError(f"missing columns {missing}; {path} has {list(header)}")
    return T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in header])


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = S.FLIGHT_SCHEMA,
    bad_rows: BadRows = "fail",
) -> DataFrame:
    """Delimited raw records, each file in whatever column order its header gives.

    Files with the same header are read together; columns that other files
    lack are null there. Known columns get their declared type, others stay
    text. A record with a field that does not parse, or with too few or too
    many fields, ends the job, or else (`mark`) has its line in the column
    `_bad_record`. Spark converts only the columns that a query reads;
    ingestion and the clean table read all of them.
    """
    known = {f.name: f.dataType for f in schema.fields}
    groups: dict[str, list[str]] = {}
    for file, line in sorted(first_lines(spark, [path] if isinstance(path, str) else path).items()):
        groups.setdefault(line.removeprefix("\ufeff"), []).append(file)
    if not groups:
        found = spark.createDataFrame([], schema)
        return found if bad_rows == "fail" else found.withColumn(BAD_RECORD, F.lit(None).cast("string"))
    parts = []
    for line, files in groups.items():
        declared = _declared(next(csv.reader([line])), known, files[0])
        reader = spark.read
        if bad_rows == "fail":
            reader = reader.option("mode", "FAILFAST")
        else:
            declared = declared.add(BAD_RECORD, T.StringType())
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
        parts.append(reader.schema(declared).csv(files, header=True, enforceSchema=False))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest_csv(
    spark: SparkSession,
    path: str,
    target: str,
    fmt: str = "parquet",
    bad_rows_to: str | None = None,
) -> str:
    """Delimited raw records to self-describing files that cleaning can read.

    Records that do not parse end the job, unless a second folder is named:
    then they go there, each with its line and the fields that did parse.
    """
    if bad_rows_to is None:
        scan_csv(spark, path).write.format(fmt).mode("overwrite").save(target)
        return target
    marked = scan_csv(spark, path, bad_rows="mark")
    is_bad = F.col(BAD_RECORD).isNotNull()
    good = marked.filter(~is_bad).drop(BAD_RECORD)
    good.write.format(fmt).mode("overwrite").save(target)
    marked.filter(is_bad).write.format(fmt).mode("overwrite").save(bad_rows_to)
    return target


def ingest_new_csv(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    bad_rows_to: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> str:
    """Ingest the files that have come to a folder since the last call, as Parquet.

    A stream of file names over the folder, run until nothing new is left: its
    checkpoint knows the files of earlier calls. Files may differ in their
    headers. Each batch of files replaces the directory of its number in
    `target` (and `bad_rows_to`), so a batch that is run again after a failure
    gives its records once. Both have the number as column `ingest_batch`.
    """

    def ingest(names: DataFrame, number: int) -> None:
        files = [row.path for row in names.select("path").collect()]
        if not files:
            return
        found = scan_csv(spark, files, bad_rows="fail" if bad_rows_to is None else "mark")
        places = {target: found}
        if bad_rows_to is not None:
            is_bad = F.col(BAD_RECORD).isNotNull()
            places = {target: found.where(~is_bad).drop(BAD_RECORD), bad_rows_to: found.where(is_bad)}
        for place, records in places.items():
            (
                records.withColumn(BATCH, F.lit(number))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BATCH)
                .parquet(place)
            )

    # Of a binary file only the columns asked for are read: its name.
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("path")
    )
    run = (
        names.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return target
