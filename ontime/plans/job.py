"""Raw records to clean table, reports and keyed records, in one job or stage by stage."""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.operators.cleaning import clean_flights
from ontime.operators.labels import report_labels
from ontime.operators.quantiles import SKETCH_K
from ontime.operators.reuse import cached
from ontime.plans import exports, reports
from ontime.session import session, temporary_folders
from ontime.sinks import write_partitioned, write_report_csv
from ontime.sources import scan_partitioned, scan_raw

# A full run replaces the tables; an incremental one the months that it brings.
Replace = Literal["table", "touched"]
# The last one reads stored sketches instead of stored histograms.
Method = Literal["discrete", "interpolated", "sketch"]
STAGES = ("clean", "refresh", "report", "export")


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables."""

    root: str

    @property
    def clean(self) -> str:
        return f"{self.root}/clean"

    @property
    def monthly(self) -> str:
        return f"{self.root}/states/monthly"

    @property
    def delays(self) -> str:
        return f"{self.root}/states/delays"

    @property
    def sketches(self) -> str:
        return f"{self.root}/states/sketches"

    @property
    def records(self) -> str:
        return f"{self.root}/records"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def write_q3_reports(
    histogram: DataFrame, percentiles_path: str, min_max_path: str, method: Method = "discrete"
) -> None:
    """Both q3 report files from one computation of their histogram.

    What is kept between the two writes has a row per carrier, hour and minute
    of delay; the flights themselves are never cached.
    """
    with cached(histogram) as kept:
        percentiles = reports.q3_percentiles_of(kept, interpolate=method == "interpolated")
        write_report_csv(report_labels(percentiles, S.Q3_PERCENTILES_LABELS), percentiles_path)
        write_report_csv(
            report_labels(reports.q3_min_max_of(kept), S.Q3_MIN_MAX_LABELS), min_max_path
        )


def clean_table(
    raw: DataFrame, layout: Layout, replace: Replace = "table", rebalance: bool = True
) -> str:
    """Store the clean records; `rebalance=False` for input that comes month by month."""
    return write_partitioned(
        clean_flights(raw), layout.clean, rebalance=rebalance, replace=replace
    )


def refresh_monthly(flights: DataFrame, layout: Layout, replace: Replace = "table") -> str:
    """Store the monthly states of `flights`; `touched` keeps those of other months."""
    return write_partitioned(
        reports.monthly_state(flights), layout.monthly, cluster_by=(), replace=replace
    )


def refresh_delays(flights: DataFrame, layout: Layout, replace: Replace = "table") -> str:
    """Store the delay histograms of `flights`; `touched` keeps those of other months."""
    return write_partitioned(reports.monthly_delays(flights), layout.delays, replace=replace)


def refresh_sketches(
    flights: DataFrame, layout: Layout, replace: Replace = "table", k: int = SKETCH_K
) -> str:
    """Store the delay sketches of `flights`; `touched` keeps those of other months."""
    return write_partitioned(reports.monthly_sketches(flights, k), layout.sketches, replace=replace)


def refresh_states(
    flights: DataFrame, layout: Layout, replace: Replace = "table", method: Method = "discrete"
) -> None:
    """Store the states that the reports need.

    Monthly states and histograms come from one scan of the flights: what is
    kept between the two writes has a row per month, carrier, hour and minute
    of delay. With sketches there are no histograms.
    """
    if method == "sketch":
        refresh_monthly(flights, layout, replace)
        refresh_sketches(flights, layout, replace)
        return
    with cached(reports.monthly_detail(flights)) as detail:
        write_partitioned(reports.monthly_of(detail), layout.monthly, cluster_by=(), replace=replace)
        write_partitioned(reports.delays_of(detail), layout.delays, replace=replace)


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.MONTHLY_STATE_SCHEMA).parquet(path)


def read_delays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.MONTHLY_DELAYS_SCHEMA).parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.MONTHLY_SKETCHES_SCHEMA).parquet(path)


def write_reports(
    spark: SparkSession,
    layout: Layout,
    months: tuple[int, int] = reports.FIRST_MONTHS,
    threshold: int = 500,
    k: int = 10,
    method: Method = "discrete",
) -> None:
    """All four report files from the stored states."""
    monthly = read_monthly(spark, layout.monthly)
    q1 = reports.q1_from_states(monthly, months=months)
    write_report_csv(report_labels(q1, S.Q1_LABELS), layout.report("q1"))
    q2 = reports.q2_from_states(monthly, months, threshold, k)
    write_report_csv(report_labels(q2, S.Q2_LABELS), layout.report("q2"))
    percentiles_path, min_max_path = layout.report("q3_percentiles"), layout.report("q3_min_max")
    if method == "sketch":
        sketches = read_sketches(spark, layout.sketches)
        with cached(reports.q3_sketches_from_states(sketches, months=months)) as merged:
            percentiles = reports.q3_percentiles_from_sketches(merged)
            limits = reports.q3_min_max_from_sketches(merged)
            write_report_csv(report_labels(percentiles, S.Q3_PERCENTILES_LABELS), percentiles_path)
            write_report_csv(report_labels(limits, S.Q3_MIN_MAX_LABELS), min_max_path)
        return
    delays = read_delays(spark, layout.delays)
    histogram = reports.q3_histogram_from_states(delays, months=months)
    write_q3_reports(histogram, percentiles_path, min_max_path, method)


def export_reports(
    spark: SparkSession,
    layout: Layout,
    sink: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """All four reports to keyed records, whole. The first failure ends the job.

    `sink` is `parquet` for keyed tables below the root, else the format name
    of a key-value connector on the classpath, with its options.
    """
    if sink == "parquet":
        upsert, replace = exports.parquet_sinks(layout.records)
    else:
        upsert, replace = exports.connector_sinks(sink, options)
    exports.export_q1(spark, layout.report("q1"), upsert)
    exports.export_q2(spark, layout.report("q2"), replace)
    exports.export_q3_p(spark, layout.report("q3_percentiles"), upsert)
    exports.export_q3_mm(spark, layout.report("q3_min_max"), upsert)


def touched_months(spark: SparkSession, raw_path: str, fmt: str, layout: Layout) -> DataFrame:
    """The clean records of the months that occur in the raw input.

    A join with those months, which Spark turns into a filter on directories
    when it runs: other months are not read. Of the raw input only the month is
    read. Months have two digits, so at most a hundred rows are broadcast.
    """
    months = scan_raw(spark, raw_path, fmt).select(S.MONTH).where(F.col(S.MONTH).between(0, 99))
    return scan_partitioned(spark, layout.clean).join(F.broadcast(months.distinct()), S.MONTH, "left_semi")


def run(
    spark: SparkSession,
    raw_path: str,
    root: str,
    fmt: str = "avro",
    months: tuple[int, int] = reports.FIRST_MONTHS,
    threshold: int = 500,
    k: int = 10,
    replace: Replace = "table",
    method: Method = "discrete",
    sink: str = "parquet",
    options: Mapping[str, str] | None = None,
    rebalance: bool = True,
    stages: tuple[str, ...] = STAGES,
) -> Layout:
    """Clean, summarise by month, report and export, or only some of it.

    Each stage reads what the one before has written. The clean table is
    scanned once for all states (twice with sketches); reports never scan it. By default tables
    are replaced, so a run gives what its input holds and no more;
    `replace="touched"` replaces the months of the input, in the clean table
    and the states alike, and reads only those.
    """
    layout = Layout(root.rstrip("/"))
    with temporary_folders(spark):
        if "clean" in stages:
            clean_table(scan_raw(spark, raw_path, fmt), layout, replace, rebalance)
        if "refresh" in stages:
            clean = scan_partitioned(spark, layout.clean)
            if replace == "touched":
                clean = touched_months(spark, raw_path, fmt, layout)
            refresh_states(clean, layout, replace, method)
        if "report" in stages:
            write_reports(spark, layout, months, threshold, k, method)
        if "export" in stages:
            export_reports(spark, layout, sink, options)
    return layout


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_path")
    parser.add_argument("root")
    parser.add_argument("--stages", nargs="+", choices=STAGES, default=STAGES)
    parser.add_argument("--format", default="avro")
    parser.add_argument("--incremental", action="store_true", help="replace only the input's months")
    parser.add_argument("--no-rebalance", action="store_true", help="input comes month by month")
    parser.add_argument("--months", type=int, nargs=2, default=reports.FIRST_MONTHS)
    parser.add_argument("--min-records", type=int, default=500)
    parser.add_argument("--top", type=int, default=10)
    parser.add_argument("--percentiles", choices=("discrete", "interpolated", "sketch"), default="discrete")
    parser.add_argument("--sink", default="parquet", help="parquet, or a connector's format name")
    parser.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE")
    args = parser.parse_args()
    run(
        session(),
        args.raw_path,
        args.root,
        args.format,
        tuple(args.months),
        args.min_records,
        args.top,
        "touched" if args.incremental else "table",
        args.percentiles,
        args.sink,
        dict(option.split("=", 1) for option in args.sink_option),
        not args.no_rebalance,
        tuple(args.stages),
    )


if __name__ == "__main__":
    main()
