from __future__ import annotations

import glob

import pytest
from flight_records import records
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime import schema as S
from ontime.operators.cleaning import clean_flights
from ontime.plans import reports
from ontime.session import work_folder
from ontime.sinks import noop_run, write_partitioned, write_report_csv
from ontime.sources import (
    flights,
    ingest_csv,
    ingest_new_csv,
    scan_avro,
    scan_csv,
    scan_csv_report,
    scan_partitioned,
    scan_raw,
)


@pytest.fixture(scope="module")
def clean(spark, small_dir):
    return clean_flights(flights(spark, small_dir))


def same_rows(left, right):
    columns = sorted(left.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


@pytest.mark.parametrize("rebalance", [True, False])
def test_partitioned_round_trip(spark, clean, tmp_path, rebalance):
    root = write_partitioned(clean, str(tmp_path / "t"), rebalance=rebalance)
    assert len(glob.glob(f"{root}/MONTH=*")) == 12
    back = scan_partitioned(spark, root)
    assert same_rows(back, clean)
    assert same_rows(scan_partitioned(spark, root, months=(2, 3)), clean.filter("MONTH IN (2, 3)"))


def test_rewrite_of_touched_months_keeps_the_others(spark, clean, tmp_path):
    root = write_partitioned(clean, str(tmp_path / "t"))
    march = clean.filter("MONTH = 3").limit(10)
    write_partitioned(march, root, replace="touched")
    counted = scan_partitioned(spark, root).groupBy("MONTH").count()
    counts = {r["MONTH"]: r["count"] for r in records(counted)}
    assert counts[3] == 10
    assert counts[4] == clean.filter("MONTH = 4").count()
    write_partitioned(march, root)
    assert scan_partitioned(spark, root).count() == 10


def test_large_month_becomes_several_files(spark, tmp_path):
    """Nine tenths of the rows in one month: AQE splits its writer."""
    df = spark.range(0, 400_000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 12 + 1).otherwise(1).cast("int").alias("MONTH"),
        F.lit("AA").alias(S.CARRIER),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        root = write_partitioned(df, str(tmp_path / "t"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(glob.glob(f"{root}/MONTH=1/*.parquet")) > 4
    assert len(glob.glob(f"{root}/MONTH=7/*.parquet")) <= 2
    assert spark.read.parquet(root).count() == 400_000


def test_zero_padded_directories(spark, clean, tmp_path):
    padded = clean.withColumn("mese", F.lpad(F.col(S.MONTH).cast("string"), 2, "0"))
    root = write_partitioned(padded, str(tmp_path / "t"), partition_col="mese")
    assert glob.glob(f"{root}/mese=01")
    back = scan_partitioned(spark, root, months=(1, 4), partition_col="mese")
    assert {r["mese"] for r in records(back.select("mese").distinct())} == {1, 2, 3, 4}
    assert same_rows(back.drop("mese"), clean.filter("MONTH <= 4"))


def test_extra_columns_survive_without_a_schema(spark, clean, tmp_path):
    root = write_partitioned(clean.withColumn("TAIL", F.lit("N1")), str(tmp_path / "t"))
    assert "TAIL" in scan_partitioned(spark, root, schema=None).columns


def test_report_file(spark, clean, tmp_path):
    report = reports.q1_monthly_delay(clean)
    path = write_report_csv(report, str(tmp_path / "q1"))
    (file,) = glob.glob(f"{path}/*.csv")
    with open(file) as lines:
        text = lines.read().splitlines()
    assert text[0] == ",".join(S.Q1_SCHEMA.names)
    assert [line.split(",")[:2] for line in text[1:]] == [
        [str(m), c] for m in (1, 2, 3, 4) for c in ("AA", "DL")
    ]
    assert scan_csv_report(spark, path, S.Q1_SCHEMA).collect() == report.collect()


def test_report_with_other_headings_fails(spark, clean, tmp_path):
    path = write_report_csv(reports.q3_min_max(clean), str(tmp_path / "mm"))
    wrong = S.labelled(S.Q3_MIN_MAX_SCHEMA, S.Q3_MIN_MAX_LABELS)
    with pytest.raises(Exception, match="header"):
        scan_csv_report(spark, path, wrong).collect()


def test_csv_in_another_column_order_with_extra_columns(spark, tmp_path):
    header = ["TAIL_NUM", *reversed(S.FLIGHT_SCHEMA.names)]
    good = ["N1", "1", "2", "3", "4", "5", "17", "8", "0.00", "0.00", "0935", "AA", "2"]
    bad = ["N2", "", "", "", "", "", "", "", "0.00", "zero", "0935", "AA", "2"]
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(map(",".join, [header, good, bad])) + "\n")
    rows = {r["TAIL_NUM"]: r for r in records(scan_csv(spark, str(folder), bad_rows="mark"))}
    assert rows["N1"][S.SCHEDULED_DEPARTURE] == 935
    assert rows["N1"]["LATE_AIRCRAFT_DELAY"] == 1.0
    assert rows["N1"][S.MONTH] == 2
    assert rows["N1"]["_bad_record"] is None
    assert rows["N2"]["_bad_record"] == ",".join(bad)
    # A bad record ends the job, unless it has a place to go to.
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        ingest_csv(spark, str(folder), str(tmp_path / "failed"))
    turned_away = str(tmp_path / "bad")
    raw = ingest_csv(spark, str(folder), str(tmp_path / "raw"), bad_rows_to=turned_away)
    stored = scan_raw(spark, raw, "parquet")
    assert [r["TAIL_NUM"] for r in records(stored)] == ["N1"]
    assert [r["_bad_record"] for r in records(spark.read.parquet(turned_away))] == [",".join(bad)]
    assert clean_flights(stored).count() == 1


RECORD = dict(zip(S.FLIGHT_SCHEMA.names, ["1", "AA", "900", "0.0", "0.0", *["1.0"] * 7], strict=True))


def csv_file(path, columns, *overrides):
    rows = [{**RECORD, **extra} for extra in overrides]
    path.parent.mkdir(exist_ok=True)
    path.write_text("".join(",".join(line) + "\n" for line in [columns, *([r[c] for c in columns] for r in rows)]))


def test_csv_files_with_headers_of_their_own(spark, tmp_path):
    names = S.FLIGHT_SCHEMA.names
    folder = tmp_path / "csv"
    csv_file(folder / "a.csv", names, {S.MONTH: "1"}, {S.MONTH: "2"})
    csv_file(folder / "b.csv", names[::-1], {S.MONTH: "3"})
    csv_file(folder / "c.csv", [*names[5:], "TAIL", *names[:5]], {S.MONTH: "4", "TAIL": "N4"})
    csv_file(folder / "d.csv", names, {S.MONTH: "5"})
    (folder / "empty.csv").write_text("")
    csv_file(folder / "header.csv", names)
    found = {r[S.MONTH]: r for r in records(scan_csv(spark, str(folder)))}
    assert sorted(found) == [1, 2, 3, 4, 5]
    assert {m: r["TAIL"] for m, r in found.items() if r["TAIL"]} == {4: "N4"}
    assert all(r[S.CARRIER] == "AA" and r[S.SCHEDULED_DEPARTURE] == 900 for r in found.values())
    assert scan_raw(spark, ingest_csv(spark, str(folder), str(tmp_path / "raw")), "parquet").count() == 5
    csv_file(folder / "e.csv", names[1:], {})
    with pytest.raises(ValueError, match="missing columns .'MONTH'.; .*e.csv"):
        scan_csv(spark, str(folder))


def test_no_csv_records(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("")
    assert scan_csv(spark, str(tmp_path / "csv")).schema == S.FLIGHT_SCHEMA
    assert scan_csv(spark, str(tmp_path / "csv"), bad_rows="mark").count() == 0


def test_only_files_not_seen_before_are_ingested(spark, tmp_path):
    names = S.FLIGHT_SCHEMA.names
    folder, target, bad = tmp_path / "csv", str(tmp_path / "raw"), str(tmp_path / "bad")
    places = dict(checkpoint=str(tmp_path / "seen"), bad_rows_to=bad)
    csv_file(folder / "a.csv", names, {S.MONTH: "1"}, {S.MONTH: "x"})
    csv_file(folder / "b.csv", names[::-1], {S.MONTH: "2"})
    ingest_new_csv(spark, str(folder), target, **places)

    def months(batch):
        rows = spark.read.parquet(target).where(F.col("ingest_batch") == batch)
        return sorted(r[S.MONTH] for r in records(rows))

    assert months(0) == [1, 2]
    assert [r["ingest_batch"] for r in records(spark.read.parquet(bad))] == [0]
    ingest_new_csv(spark, str(folder), target, **places)
    assert scan_raw(spark, target, "parquet").count() == 2
    (folder / "a.csv").unlink()
    csv_file(folder / "c.csv", [*names, "TAIL"], {S.MONTH: "3", "TAIL": "N3"})
    ingest_new_csv(spark, str(folder), target, **places)
    assert months(1) == [3]
    assert scan_raw(spark, target, "parquet").count() == 3


def test_a_batch_of_files_that_failed_is_ingested_once(spark, tmp_path):
    names = S.FLIGHT_SCHEMA.names
    folder, target, seen = tmp_path / "csv", str(tmp_path / "raw"), str(tmp_path / "seen")
    csv_file(folder / "a.csv", names, {S.MONTH: "1"}, {S.MONTH: "x"})
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest_new_csv(spark, str(folder), target, seen)
    csv_file(folder / "a.csv", names, {S.MONTH: "1"}, {S.MONTH: "2"})
    ingest_new_csv(spark, str(folder), target, seen)
    assert sorted(r[S.MONTH] for r in records(scan_raw(spark, target, "parquet"))) == [1, 2]


def test_few_files_to_a_batch(spark, tmp_path):
    folder, target = tmp_path / "csv", str(tmp_path / "raw")
    for month in range(1, 6):
        csv_file(folder / f"{month}.csv", S.FLIGHT_SCHEMA.names, {S.MONTH: str(month)})
    ingest_new_csv(spark, str(folder), target, str(tmp_path / "seen"), files_per_batch=2)
    found = spark.read.parquet(target)
    assert sorted(r[S.MONTH] for r in records(found)) == [1, 2, 3, 4, 5]
    assert found.select("ingest_batch").distinct().count() == 3


def test_csv_bad_fields_end_the_job(spark, tmp_path):
    fields = ["1", "AA", "900", "0.0", "0.0", "1.0", "1.0", "0.0", "0.0", "0.0", "0.0", "x"]
    (tmp_path / "a.csv").write_text(f"{','.join(S.FLIGHT_SCHEMA.names)}\n{','.join(fields)}\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        noop_run(clean_flights(scan_raw(spark, str(tmp_path), "csv")))


def test_csv_without_a_needed_column_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("MONTH\n1\n")
    with pytest.raises(ValueError, match="missing columns"):
        scan_csv(spark, str(tmp_path))


def test_raw_types_are_made_to_conform(spark, clean, tmp_path):
    as_text = clean.select([F.col(c).cast("string") for c in clean.columns])
    as_text.withColumn("TAIL", F.lit("N1")).write.parquet(str(tmp_path / "raw"))
    back = scan_raw(spark, str(tmp_path / "raw"), "parquet")
    assert [f.dataType for f in back.schema][:12] == [f.dataType for f in S.FLIGHT_SCHEMA]
    assert same_rows(back.drop("TAIL"), clean)


def test_avro(spark, clean, tmp_path):
    try:
        clean.limit(5).write.format("avro").save(str(tmp_path / "raw"))
    except Exception as failure:
        pytest.skip(f"no Avro source on the classpath: {type(failure).__name__}")
    assert scan_avro(spark, str(tmp_path / "raw" / "*.avro")).count() == 5


def test_noop_counts_rows(clean):
    assert noop_run(clean) == 5761
    assert noop_run(clean.limit(0)) == 0


def test_schema_check(clean):
    S.require_schema(clean, S.FLIGHT_SCHEMA)
    with pytest.raises(TypeError, match="MONTH"):
        S.require_schema(
            clean.withColumn("MONTH", F.col("MONTH").cast("string")), S.FLIGHT_SCHEMA
        )
    assert T.StructType(S.FLIGHT_SCHEMA.fields) == S.FLIGHT_SCHEMA


def test_work_folder_is_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second
    assert first.startswith(shared)
