"""Report files to keyed records."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import composite_key, rank_key
from ontime.operators.labels import canonical_names
from ontime.operators.ranking import rank_all
from ontime.sinks import keyed_replace, keyed_upsert, write_keyed_connector
from ontime.sources import scan_csv_report

Sink = Callable[[DataFrame, str], object]


def q1_records(spark: SparkSession, path: str) -> DataFrame:
    """Monthly report as records with key `carrier:month`."""
    schema = S.labelled(S.Q1_SCHEMA, S.Q1_LABELS)
    return (
        scan_csv_report(spark, path, schema)
        .transform(canonical_names, S.Q1_RECORD_FIELDS)
        .withColumn("key", composite_key("compagnia", "mese"))
    )


def q2_records(spark: SparkSession, path: str) -> DataFrame:
    """Carrier report as records with the leaderboard position as key.

    Every row of the report is ranked, whatever their number.
    """
    schema = S.labelled(S.Q2_SCHEMA, S.Q2_LABELS)
    report = scan_csv_report(spark, path, schema)
    return (
        report.transform(canonical_names, S.Q2_RECORD_FIELDS)
        .transform(rank_all, "ritardo_medio_arr", "compagnia", "posizione")
        .withColumn("posizione", F.col("posizione").cast("int"))
        .withColumn("key", rank_key("posizione"))
    )


def q3_percentile_records(spark: SparkSession, path: str) -> DataFrame:
    """Percentile report as records with key `carrier:hour`."""
    schema = S.labelled(S.Q3_PERCENTILES_SCHEMA, S.Q3_PERCENTILES_LABELS)
    return (
        scan_csv_report(spark, path, schema)
        .transform(canonical_names, S.Q3_PERCENTILES_RECORD_FIELDS)
        .withColumn("key", composite_key("compagnia", "Fascia_oraria"))
    )


def q3_min_max_records(spark: SparkSession, path: str) -> DataFrame:
    """Min/max report as records with the carrier as key."""
    schema = S.labelled(S.Q3_MIN_MAX_SCHEMA, S.Q3_MIN_MAX_LABELS)
    return (
        scan_csv_report(spark, path, schema)
        .transform(canonical_names, S.Q3_MIN_MAX_RECORD_FIELDS)
        .withColumn("key", composite_key("compagnia"))
    )


def parquet_sinks(root: str) -> tuple[Sink, Sink]:
    """(upsert, replace) into keyed tables below `root`."""
    return (
        lambda records, table: keyed_upsert(records, root, table),
        lambda records, table: keyed_replace(records, root, table),
    )


def connector_sinks(fmt: str, options: Mapping[str, str] | None = None) -> tuple[Sink, Sink]:
    """(upsert, replace) through a key-value connector on the classpath."""
    return (
        lambda records, table: write_keyed_connector(records, table, fmt, "append", "key", options),
        lambda records, table: write_keyed_connector(records, table, fmt, "overwrite", "key", options),
    )


def export_q1(spark: SparkSession, path: str, upsert: Sink) -> None:
    upsert(q1_records(spark, path), "q1")


def export_q2(spark: SparkSession, path: str, replace: Sink) -> None:
    replace(q2_records(spark, path), "q2")


def export_q3_p(spark: SparkSession, path: str, upsert: Sink) -> None:
    upsert(q3_percentile_records(spark, path), "q3_p")


def export_q3_mm(spark: SparkSession, path: str, upsert: Sink) -> None:
    upsert(q3_min_max_records(spark, path), "q3_mm")
