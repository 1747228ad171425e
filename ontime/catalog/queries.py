"""Named queries: each runs one operator over the whole `lineitem`-derived flights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import (
    composite_key,
    default_cast,
    hour_bucket,
    percentile_fields,
    rank_key,
    rate_pct,
    round2,
    strict_cast,
)
from ontime.operators import aggregates as A
from ontime.operators import cleaning, filters, labels, quantiles, ranking, states
from ontime.plans import exports, job, reports
from ontime.session import work_folder
from ontime.sinks import (
    keyed_replace,
    keyed_upsert,
    noop_run,
    read_keyed,
    write_partitioned,
    write_report_csv,
)
from ontime.sources.lineitem_flights import CARRIER_SHARES, OTHER_CARRIER
from ontime.sources import (
    flights,
    ingest_csv,
    ingest_new_csv,
    scan_csv_report,
    scan_partitioned,
    scan_raw,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

MONTH_CARRIER = [S.MONTH, S.CARRIER]
FLIGHT_COLUMNS = S.FLIGHT_SCHEMA.names
# Thresholds of the carrier report that leave enough carriers at small scale.
FEW_RECORDS = 150
SKETCH_SIZE = 1000
SKETCH_RANK_ERROR = 0.02
APPROX_ACCURACY = 100


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


@query("clean_flights")
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_flights(flights(spark, sf_dir))


# Sources and file sinks: written to a fresh shared folder and read back.


@query("scan_raw_files")
def scan_raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "raw")
    flights(spark, sf_dir).write.parquet(folder)
    return scan_raw(spark, f"{folder}/*.parquet", "parquet")


@query("scan_partitioned")
def scan_partitioned_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_partitioned(clean(spark, sf_dir), work_folder(spark, "clean"))
    return scan_partitioned(spark, folder, months=(1, 4)).select(*FLIGHT_COLUMNS)


@query("scan_partitioned_alias")
def scan_partitioned_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-padded directories `mese=01` with MONTH as a data column."""
    padded = clean(spark, sf_dir).withColumn("mese", F.lpad(F.col(S.MONTH).cast("string"), 2, "0"))
    folder = write_partitioned(padded, work_folder(spark, "mese"), partition_col="mese")
    return scan_partitioned(spark, folder, months=(1, 4), partition_col="mese")


# Operators whose feature is neither a month range nor a choice of carriers
# run over all of them.
ALL_MONTHS = (1, 12)
ALL_CARRIERS = (*CARRIER_SHARES.values(), OTHER_CARRIER)


def all_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.q1_monthly_delay(clean(spark, sf_dir), ALL_CARRIERS, ALL_MONTHS)


def all_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.q2_carriers(clean(spark, sf_dir), ALL_MONTHS, threshold=FEW_RECORDS)


@query("scan_csv_report")
def scan_csv_report_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = all_monthly(spark, sf_dir)
    path = write_report_csv(report, work_folder(spark, "q1-csv"), single_file=False)
    return scan_csv_report(spark, path, S.Q1_SCHEMA)


@query("ingest_csv")
def ingest_csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "csv")
    flights(spark, sf_dir).write.csv(folder, header=True)
    return scan_raw(spark, ingest_csv(spark, folder, work_folder(spark, "raw")), "parquet")


@query("ingest_csv_bad_rows")
def ingest_csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which every 41st order has a month that is no number, and their parsed fields."""
    folder, bad = work_folder(spark, "csv"), work_folder(spark, "bad")
    lines = flights(spark, sf_dir, keep=("l_orderkey",)).withColumn(
        S.MONTH,
        F.when(F.col("l_orderkey") % 41 == 0, F.concat(F.col(S.MONTH), F.lit(".5"))).otherwise(
            F.col(S.MONTH).cast("string")
        ),
    )
    lines.drop("l_orderkey").write.csv(folder, header=True)
    good = scan_raw(
        spark, ingest_csv(spark, folder, work_folder(spark, "raw"), bad_rows_to=bad), "parquet"
    )
    kept = good.withColumn("line", F.lit(None).cast("string"))
    turned_away = spark.read.parquet(bad).withColumnRenamed("_bad_record", "line")
    return kept.unionByName(turned_away).select("line", S.CARRIER, S.SCHEDULED_DEPARTURE)


def two_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records of the first and, in another column order with one more column, of the second half."""
    raw = flights(spark, sf_dir)
    later = raw.where(F.col(S.MONTH) > 6).withColumn("TAIL_NUM", F.concat(F.lit("N"), S.MONTH))
    return raw.where(F.col(S.MONTH) <= 6), later.select(*reversed(later.columns))


@query("ingest_csv_headers")
def ingest_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of files with two different headers."""
    folder = work_folder(spark, "csv")
    for part in two_halves(spark, sf_dir):
        part.write.mode("append").csv(folder, header=True)
    return scan_raw(spark, ingest_csv(spark, folder, work_folder(spark, "raw")), "parquet")


@query("ingest_csv_new")
def ingest_csv_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder ingested after each of two deliveries, and once more without any."""
    folder, target, seen = (work_folder(spark, name) for name in ("csv", "raw", "seen"))
    for part in two_halves(spark, sf_dir):
        part.write.mode("append").csv(folder, header=True)
        ingest_new_csv(spark, folder, target, seen)
    ingest_new_csv(spark, folder, target, seen)
    # Of files in columns of their own, those of one batch may lack what others have.
    found = spark.read.option("mergeSchema", "true").parquet(target)
    return found.select(*FLIGHT_COLUMNS, "TAIL_NUM", "ingest_batch")


@query("write_partitioned")
def write_partitioned_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_partitioned(clean(spark, sf_dir), work_folder(spark, "clean"))
    return scan_partitioned(spark, folder).select(*FLIGHT_COLUMNS)


@query("write_report_csv")
def write_report_csv_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = labels.report_labels(all_carriers(spark, sf_dir), S.Q2_LABELS)
    path = write_report_csv(report, work_folder(spark, "q2-csv"))
    return scan_csv_report(spark, path, S.labelled(S.Q2_SCHEMA, S.Q2_LABELS))


@query("noop_run")
def noop_run_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = noop_run(clean(spark, sf_dir))
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows"))


def month_records(df: DataFrame, first: int, last: int) -> DataFrame:
    return reports.q1_monthly_delay(df, ALL_CARRIERS, (first, last)).withColumn(
        "key", composite_key("carrier", "month")
    )


@query("keyed_upsert")
def keyed_upsert_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional figures of months 1-8 from raw records, then 5-12 from clean ones."""
    root = work_folder(spark, "records")
    keyed_upsert(month_records(flights(spark, sf_dir), 1, 8), root, "q1")
    keyed_upsert(month_records(clean(spark, sf_dir), 5, 12), root, "q1")
    return read_keyed(spark, root, "q1")


@query("keyed_replace")
def keyed_replace_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ranking of all carriers with few flights, replaced by the strict one."""
    root = work_folder(spark, "records")
    for threshold in (FEW_RECORDS, 500):
        ranked = ranking.leaderboard_rank(
            reports.q2_carriers(clean(spark, sf_dir), ALL_MONTHS, threshold),
            "arr_delay_mean",
            10,
            "carrier",
        )
        keyed_replace(ranked.withColumn("key", rank_key("position")), root, "q2")
    return read_keyed(spark, root, "q2")


# Filters and cleaning rules.


@query("require_fields")
def require_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.require_fields(flights(spark, sf_dir))


@query("explained_null_arr")
def explained_null_arr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.explained_null(
        flights(spark, sf_dir), S.ARR_DELAY, [S.CANCELLED, S.DIVERTED]
    )


@query("explained_null_dep")
def explained_null_dep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.explained_null(flights(spark, sf_dir), S.DEP_DELAY, [S.CANCELLED])


@query("explained_null")
def explained_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rules, one after the other."""
    return cleaning.explained_null(
        explained_null_arr(spark, sf_dir), S.DEP_DELAY, [S.CANCELLED]
    )


@query("carrier_filter")
def carrier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.carrier_filter(clean(spark, sf_dir), reports.Q1_CARRIERS)


@query("completed_filter")
def completed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.completed_filter(clean(spark, sf_dir))


@query("operated_filter")
def operated_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.operated_filter(clean(spark, sf_dir))


def text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights whose flags are text, some missing or no number, some carriers empty."""
    order = F.col("l_orderkey")
    return flights(spark, sf_dir, keep=("l_orderkey",)).select(
        S.MONTH,
        F.when(order % 67 == 0, F.lit("")).otherwise(F.col(S.CARRIER)).alias(S.CARRIER),
        F.when(order % 59 == 0, F.lit("x"))
        .when(order % 61 != 0, F.col(S.CANCELLED).cast("string"))
        .alias(S.CANCELLED),
        F.when(order % 73 == 0, F.lit("?"))
        .when(order % 79 != 0, F.col(S.DIVERTED).cast("string"))
        .alias(S.DIVERTED),
        S.DEP_DELAY,
        S.ARR_DELAY,
    )


@query("lenient_flags")
def lenient_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.lenient_completed_filter(text_flags(spark, sf_dir))


@query("lenient_flags_carriers")
def lenient_flags_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.lenient_operated_filter(text_flags(spark, sf_dir), reports.Q3_CARRIERS)


@query("min_records")
def min_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = A.group_count(clean(spark, sf_dir), MONTH_CARRIER)
    return filters.min_records(counted, 500)


@query("month_range")
def month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.month_range(clean(spark, sf_dir), 1, 4)


@query("normalize_causes")
def normalize_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize_causes(flights(spark, sf_dir))


# Projections and scalar functions.


@query("hour_bucket")
def hour_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).select(
        S.SCHEDULED_DEPARTURE, hour_bucket(S.SCHEDULED_DEPARTURE).alias("hour_bucket")
    )


@query("default_cast")
def default_cast_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = F.col(S.DEP_DELAY).cast("string")
    return flights(spark, sf_dir).select(*MONTH_CARRIER, default_cast(delay).alias("delay"))


@query("strict_cast")
def strict_cast_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    completed = filters.completed_filter(clean(spark, sf_dir))
    return completed.select(
        S.CARRIER,
        *[
            strict_cast(F.col(c).cast("string")).alias(c)
            for c in (S.ARR_DELAY, *S.CAUSES)
        ],
    )


@query("round2")
def round2_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighths of a minute: three decimals, a quarter of them exact ties."""
    return flights(spark, sf_dir).select(
        S.DEP_DELAY, round2(F.col(S.DEP_DELAY) / 8).alias("rounded")
    )


@query("rate_pct")
def rate_pct_diverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = rate_pct(F.sum(S.DIVERTED), F.count(F.lit(1)))
    return clean(spark, sf_dir).groupBy(*MONTH_CARRIER).agg(share.alias("diverted_pct"))


@query("percentile_columns")
def percentile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = quantiles.QUARTILES_AND_P90_NAMES
    found = quantiles.percentiles_discrete(clean(spark, sf_dir), [S.CARRIER])
    return found.select(S.CARRIER, F.array(*names).alias("quantiles")).select(
        S.CARRIER, *percentile_fields("quantiles", names)
    )


@query("positional_project")
def positional_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.project(
        clean(spark, sf_dir), [S.MONTH, S.CARRIER, S.CANCELLED, S.DEP_DELAY]
    )


@query("report_labels")
def report_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.report_labels(all_monthly(spark, sf_dir), S.Q1_LABELS)


@query("canonical_names")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.canonical_names(report_labels(spark, sf_dir), S.Q1_RECORD_FIELDS)


@query("composite_key")
def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = clean(spark, sf_dir).select(
        S.CARRIER, hour_bucket(S.SCHEDULED_DEPARTURE).alias("hour_bucket")
    )
    counted = A.group_count(hours, [S.CARRIER, "hour_bucket"])
    return counted.select(composite_key(S.CARRIER, "hour_bucket").alias("key"), "records")


@query("rank_key")
def rank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaderboard_rank(spark, sf_dir).select(rank_key("position").alias("key"), "carrier")


@query("single_key")
def single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = reports.q3_min_max(clean(spark, sf_dir), ALL_CARRIERS, ALL_MONTHS)
    return limits.withColumn("key", composite_key("carrier"))


# Aggregations.


@query("cond_agg")
def cond_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cond_agg(clean(spark, sf_dir), MONTH_CARRIER)


@query("cancel_rate")
def cancel_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cancel_rate(clean(spark, sf_dir), MONTH_CARRIER)


@query("group_count")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_count(clean(spark, sf_dir), [S.CARRIER])


@query("multi_mean")
def multi_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    completed = filters.completed_filter(clean(spark, sf_dir))
    return A.multi_mean(completed, [S.CARRIER], reports.Q2_MEANS)


@query("min_max")
def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.min_max(clean(spark, sf_dir), [S.CARRIER])


@query("percentiles_discrete")
def percentiles_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantiles.percentiles_discrete(clean(spark, sf_dir), MONTH_CARRIER)


@query("percentiles_discrete_prices")
def percentiles_discrete_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly all values distinct: prices per return flag and line status."""
    return quantiles.percentiles_discrete(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        ["l_returnflag", "l_linestatus"],
        "l_extendedprice",
    )


@query("percentiles_discrete_times")
def percentiles_discrete_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct points in time close together: all of a type share a cell at first."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    times = events.select("event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return quantiles.percentiles_discrete(times, ["event_type"], "at")


@query("percentiles_interpolated")
def percentiles_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quantiles.percentiles_interpolated(clean(spark, sf_dir), MONTH_CARRIER)
    names = quantiles.QUARTILES_AND_P90_NAMES
    return found.select(*MONTH_CARRIER, *[round2(name).alias(name) for name in names])


@query("percentiles_approx")
def percentiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is every estimate within the promised rank error?"""
    df, keys = clean(spark, sf_dir), [S.CARRIER]
    error = quantiles.rank_error(
        quantiles.value_histogram(df, keys),
        quantiles.percentiles_approx(df, keys, accuracy=APPROX_ACCURACY),
        keys,
    )
    bound = 1 / APPROX_ACCURACY + 1 / F.col("present")
    return error.select(*keys, "present", (F.col("rank_error") <= bound).alias("within_bound"))


@query("quantile_sketch")
def quantile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly sketches merged per carrier: exact counts, bounded rank error."""
    df, keys = clean(spark, sf_dir), [S.CARRIER]
    monthly = quantiles.quantile_sketch(df, MONTH_CARRIER, k=SKETCH_SIZE)
    merged = quantiles.merge_sketch(monthly, keys, k=SKETCH_SIZE)
    error = quantiles.rank_error(
        quantiles.value_histogram(df, keys),
        quantiles.read_sketch(merged, keys),
        keys,
        carry=["n"],
    )
    bound = F.col("rank_error") <= SKETCH_RANK_ERROR
    return error.select(*keys, "n", bound.alias("within_bound"))


def small_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values far below 0.01, in which a rounded percentile would be lost."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_returnflag", (F.col("l_discount").cast("double") / 1000).alias("small")
    )


@query("percentiles_approx_small")
def percentiles_approx_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, keys = small_values(spark, sf_dir), ["l_returnflag"]
    error = quantiles.rank_error(
        quantiles.value_histogram(df, keys, "small"),
        quantiles.percentiles_approx(df, keys, "small", accuracy=APPROX_ACCURACY),
        keys,
        "small",
    )
    bound = 1 / APPROX_ACCURACY + 1 / F.col("present")
    return error.select(*keys, "present", (F.col("rank_error") <= bound).alias("within_bound"))


@query("quantile_sketch_small")
def quantile_sketch_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, keys = small_values(spark, sf_dir), ["l_returnflag"]
    sketches = quantiles.quantile_sketch(df, keys, "small", k=SKETCH_SIZE)
    error = quantiles.rank_error(
        quantiles.value_histogram(df, keys, "small"),
        quantiles.read_sketch(sketches, keys),
        keys,
        "small",
        carry=["n"],
    )
    return error.select(
        *keys, "n", (F.col("rank_error") <= SKETCH_RANK_ERROR).alias("within_bound")
    )


@query("merge_state_q1")
def carrier_delay_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = states.delay_state(clean(spark, sf_dir), MONTH_CARRIER)
    return states.merge_delay_state(monthly, [S.CARRIER])


@query("merge_state_q2")
def carrier_sum_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    completed = filters.completed_filter(clean(spark, sf_dir))
    monthly = states.sum_state(completed, MONTH_CARRIER, list(reports.Q2_MEANS))
    return states.merge_sum_state(monthly, [S.CARRIER], list(reports.Q2_MEANS))


@query("finalize_state_q1")
def finalize_state_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.finalize_delay_state(carrier_delay_state(spark, sf_dir), [S.CARRIER])


@query("finalize_state_q2")
def finalize_state_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.finalize_sum_state(
        carrier_sum_state(spark, sf_dir), [S.CARRIER], reports.Q2_MEANS
    )


# Ranking, reuse, and the composite jobs.


@query("leaderboard_rank")
def leaderboard_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.leaderboard_rank(all_carriers(spark, sf_dir), "arr_delay_mean", 10, "carrier").select(
        "position", "carrier", "arr_delay_mean"
    )


@query("sorted_report")
def sorted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = A.group_count(clean(spark, sf_dir), MONTH_CARRIER)
    return ranking.sorted_report(counted, MONTH_CARRIER)


@query("top_k")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_k(all_carriers(spark, sf_dir), "arr_delay_mean", 10, "carrier")


@query("rank_all")
def rank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of every order by its quantity, ranked by several tasks."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = items.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    return ranking.rank_all(orders, "quantity", "l_orderkey", partitions=8)


@query("shared_subplan")
def shared_subplan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both q3 report files from one cached input, read back side by side."""
    percentiles, limits = work_folder(spark, "q3-p"), work_folder(spark, "q3-mm")
    histogram = reports.q3_histogram(clean(spark, sf_dir), ALL_CARRIERS, ALL_MONTHS)
    job.write_q3_reports(histogram, percentiles, limits)
    back = [
        labels.canonical_names(
            scan_csv_report(spark, path, S.labelled(schema, headings)),
            {heading: name for name, heading in headings.items()},
        )
        for path, schema, headings in (
            (percentiles, S.Q3_PERCENTILES_SCHEMA, S.Q3_PERCENTILES_LABELS),
            (limits, S.Q3_MIN_MAX_SCHEMA, S.Q3_MIN_MAX_LABELS),
        )
    ]
    return back[0].unionByName(back[1], allowMissingColumns=True)


@query("q1_monthly_delay")
def q1_monthly_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.q1_monthly_delay(clean(spark, sf_dir))


@query("q2_top_carriers")
def q2_top_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.q2_top_carriers(clean(spark, sf_dir))


@query("q3_percentiles")
def q3_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.q3_percentiles(clean(spark, sf_dir))


@query("q3_percentiles_interpolated")
def q3_percentiles_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.q3_percentiles(clean(spark, sf_dir), method="interpolated")


@query("q3_min_max")
def q3_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.q3_min_max(clean(spark, sf_dir))


def stored(df: DataFrame, refresh: Callable, read: Callable) -> DataFrame:
    """A state table, written and read back."""
    spark = df.sparkSession
    return read(spark, refresh(df, job.Layout(work_folder(spark, "states"))))


def stored_monthly(df: DataFrame) -> DataFrame:
    return stored(df, job.refresh_monthly, job.read_monthly)


@query("q1_from_states")
def q1_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly report from a stored state table."""
    return reports.q1_from_states(stored_monthly(clean(spark, sf_dir)))


@query("q2_from_states")
def q2_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carrier report from a stored state table."""
    return reports.q2_from_states(stored_monthly(clean(spark, sf_dir)))


@query("q1_from_states_raw")
def q1_from_states_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from raw records, of which flown ones may lack a delay."""
    return reports.q1_from_states(stored_monthly(flights(spark, sf_dir)), ALL_CARRIERS, ALL_MONTHS)


@query("q2_from_states_raw")
def q2_from_states_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = stored_monthly(flights(spark, sf_dir).where(F.col(S.CARRIER).isNotNull()))
    return reports.q2_from_states(monthly, ALL_MONTHS, threshold=1, k=len(ALL_CARRIERS))


@query("job_rerun")
def job_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all months, then one over January and February in the same place."""
    raw, part = work_folder(spark, "raw"), work_folder(spark, "raw")
    root = work_folder(spark, "job")
    flights(spark, sf_dir).write.parquet(raw)
    flights(spark, sf_dir).where(F.col(S.MONTH) <= 2).write.parquet(part)
    for path in (raw, part):
        layout = job.run(spark, path, root, "parquet", ALL_MONTHS, FEW_RECORDS)
    schema = S.labelled(S.Q2_SCHEMA, S.Q2_LABELS)
    report = scan_csv_report(spark, layout.report("q2"), schema)
    return labels.canonical_names(report, {heading: name for name, heading in S.Q2_LABELS.items()})


@query("job_touched_months")
def job_touched_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States after a run over six months and an incremental one over June and July."""
    raw, part = work_folder(spark, "raw"), work_folder(spark, "raw")
    root = work_folder(spark, "job")
    flights(spark, sf_dir).where(F.col(S.MONTH) <= 6).write.parquet(raw)
    later = flights(spark, sf_dir).where(F.col(S.MONTH).isin(6, 7) & (F.col(S.CARRIER) != "AA"))
    later.write.parquet(part)
    stages = ("clean", "refresh")
    job.run(spark, raw, root, "parquet", stages=stages)
    layout = job.run(spark, part, root, "parquet", replace="touched", stages=stages)
    monthly = job.read_monthly(spark, layout.monthly)
    return reports.q1_from_states(monthly, ALL_CARRIERS, ALL_MONTHS)


@query("q3_percentiles_from_sketches")
def q3_percentiles_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the report from stored sketches within their rank error?"""
    flown = clean(spark, sf_dir)
    path = job.refresh_sketches(flown, job.Layout(work_folder(spark, "states")), k=SKETCH_SIZE)
    merged = reports.q3_sketches_from_states(
        job.read_sketches(spark, path), ALL_CARRIERS, ALL_MONTHS, k=SKETCH_SIZE
    )
    keys = ["carrier", "hour_bucket"]
    error = quantiles.rank_error(
        reports.q3_histogram(flown, ALL_CARRIERS, ALL_MONTHS),
        reports.q3_percentiles_from_sketches(merged),
        keys,
    )
    bound = SKETCH_RANK_ERROR + 1 / F.col("present")
    return error.select(*keys, "present", (F.col("rank_error") <= bound).alias("within_bound"))


@query("q3_min_max_from_sketches")
def q3_min_max_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The min/max report from what is stored next to the sketches."""
    layout = job.Layout(work_folder(spark, "states"))
    path = job.refresh_sketches(clean(spark, sf_dir), layout, k=SKETCH_SIZE)
    merged = reports.q3_sketches_from_states(job.read_sketches(spark, path), k=SKETCH_SIZE)
    return reports.q3_min_max_from_sketches(merged)


@query("states_from_one_scan")
def states_from_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights by month and carrier, and by hour and delay, of tables written from one scan."""
    layout = job.Layout(work_folder(spark, "states"))
    job.refresh_states(clean(spark, sf_dir), layout)
    monthly = job.read_monthly(spark, layout.monthly).select(
        *MONTH_CARRIER, "flights", "cancelled", "delay_sum", "records", "arr_delay_sum"
    )
    flown = job.read_delays(spark, layout.delays).groupBy(*MONTH_CARRIER).agg(
        F.sum("n").alias("flown"), F.countDistinct("hour_bucket", S.DEP_DELAY).alias("delays")
    )
    return monthly.join(flown, MONTH_CARRIER, "left")


@query("q3_percentiles_from_states")
def q3_percentiles_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentile report from stored monthly histograms."""
    delays = stored(clean(spark, sf_dir), job.refresh_delays, job.read_delays)
    return reports.q3_percentiles_of(reports.q3_histogram_from_states(delays))


@query("q3_min_max_from_states")
def q3_min_max_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The min/max report from stored monthly histograms."""
    delays = stored(clean(spark, sf_dir), job.refresh_delays, job.read_delays)
    return reports.q3_min_max_of(reports.q3_histogram_from_states(delays))


def exported(spark: SparkSession, report: DataFrame, headings, export, table: str) -> DataFrame:
    """Report file, then keyed records, then what a reader of the records sees."""
    path = write_report_csv(labels.report_labels(report, headings), work_folder(spark, "csv"))
    root = work_folder(spark, "records")
    upsert, replace = exports.parquet_sinks(root)
    export(spark, path, replace if table == "q2" else upsert)
    return read_keyed(spark, root, table)


@query("export_q1")
def export_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported(spark, all_monthly(spark, sf_dir), S.Q1_LABELS, exports.export_q1, "q1")


@query("export_q2")
def export_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.q2_top_carriers(clean(spark, sf_dir), ALL_MONTHS, FEW_RECORDS)
    return exported(spark, report, S.Q2_LABELS, exports.export_q2, "q2")


@query("export_q2_all")
def export_q2_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report with every carrier, exported whole."""
    report = reports.q2_carriers(clean(spark, sf_dir), ALL_MONTHS, threshold=1)
    return exported(spark, report, S.Q2_LABELS, exports.export_q2, "q2")


@query("export_q3_p")
def export_q3_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.q3_percentiles(clean(spark, sf_dir), ALL_CARRIERS, ALL_MONTHS)
    return exported(spark, report, S.Q3_PERCENTILES_LABELS, exports.export_q3_p, "q3_p")


@query("export_q3_mm")
def export_q3_mm(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.q3_min_max(clean(spark, sf_dir), ALL_CARRIERS, ALL_MONTHS)
    return exported(spark, report, S.Q3_MIN_MAX_LABELS, exports.export_q3_mm, "q3_mm")
