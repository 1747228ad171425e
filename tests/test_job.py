from __future__ import annotations

import glob

import pytest
from flight_records import records

from ontime import schema as S
from ontime.operators.cleaning import clean_flights
from ontime.operators.reuse import cached
from ontime.operators import labels
from ontime.plans import exports, job, reports
from ontime.plans.bench import measure
from ontime.sinks import read_keyed, write_report_csv
from ontime.sources import flights, scan_csv_report, scan_partitioned


@pytest.fixture(scope="module")
def layout(spark, small_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    flights(spark, small_dir).write.parquet(str(folder / "raw"))
    return job.run(spark, f"{folder}/raw/*.parquet", f"{folder}/out", "parquet", threshold=100)


@pytest.fixture(scope="module")
def clean(spark, small_dir):
    return clean_flights(flights(spark, small_dir))


def test_reports_carry_their_headings(layout):
    for name, labels, rows in (
        ("q1", S.Q1_LABELS, 8),
        ("q2", S.Q2_LABELS, 6),
        ("q3_percentiles", S.Q3_PERCENTILES_LABELS, 96),
        ("q3_min_max", S.Q3_MIN_MAX_LABELS, 4),
    ):
        (file,) = glob.glob(f"{layout.report(name)}/*.csv")
        with open(file) as lines:
            text = lines.read().splitlines()
        assert text[0] == ",".join(labels.values())
        assert len(text) == rows + 1


def test_report_values(spark, layout, clean):
    for name, schema, labels, expected in (
        ("q1", S.Q1_SCHEMA, S.Q1_LABELS, reports.q1_monthly_delay(clean)),
        ("q2", S.Q2_SCHEMA, S.Q2_LABELS, reports.q2_top_carriers(clean, threshold=100)),
        (
            "q3_percentiles",
            S.Q3_PERCENTILES_SCHEMA,
            S.Q3_PERCENTILES_LABELS,
            reports.q3_percentiles(clean),
        ),
        ("q3_min_max", S.Q3_MIN_MAX_SCHEMA, S.Q3_MIN_MAX_LABELS, reports.q3_min_max(clean)),
    ):
        back = scan_csv_report(spark, layout.report(name), S.labelled(schema, labels))
        assert [tuple(r) for r in back.collect()] == [tuple(r) for r in expected.collect()]


def test_exported_records(spark, layout):
    q1 = {r["key"]: r for r in records(read_keyed(spark, layout.records, "q1"))}
    assert set(q1) == {f"q1:{c}:{m}" for c in ("AA", "DL") for m in (1, 2, 3, 4)}
    assert set(q1["q1:AA:1"]) == {"key", *S.Q1_RECORD_FIELDS.values()}
    q2 = records(read_keyed(spark, layout.records, "q2"))
    by_position = sorted(q2, key=lambda r: r["posizione"])
    assert [r["key"] for r in by_position] == [f"q2:{i}" for i in range(1, 7)]
    means = [r["ritardo_medio_arr"] for r in by_position]
    assert means == sorted(means, reverse=True)
    percentiles = {r["key"] for r in records(read_keyed(spark, layout.records, "q3_p"))}
    assert percentiles == {f"q3_p:{c}:{h}" for c in reports.Q3_CARRIERS for h in range(24)}
    limits = {r["key"] for r in records(read_keyed(spark, layout.records, "q3_mm"))}
    assert limits == {f"q3_mm:{c}" for c in reports.Q3_CARRIERS}


def test_command_line_with_delimited_input(spark, small_dir, clean, tmp_path, monkeypatch):
    flights(spark, small_dir).write.csv(str(tmp_path / "raw"), header=True)
    out = str(tmp_path / "out")
    options = ["--format", "csv", "--months", "5", "6", "--min-records", "50", "--top", "3"]
    monkeypatch.setattr("sys.argv", ["job", str(tmp_path / "raw"), out, *options])
    job.main()
    layout = job.Layout(out)
    q2 = scan_csv_report(spark, layout.report("q2"), S.labelled(S.Q2_SCHEMA, S.Q2_LABELS))
    expected = reports.q2_top_carriers(clean, (5, 6), threshold=50, k=3)
    assert [tuple(r) for r in q2.collect()] == [tuple(r) for r in expected.collect()]
    assert q2.count() == 3
    months = {r["mese"] for r in records(read_keyed(spark, layout.records, "q1"))}
    assert months == {5, 6}


def test_a_full_run_replaces_everything(spark, small_dir, clean, tmp_path):
    raw = flights(spark, small_dir)
    raw.write.parquet(str(tmp_path / "all"))
    raw.filter("MONTH <= 2").write.parquet(str(tmp_path / "some"))
    out = str(tmp_path / "out")
    for part in ("all", "some"):
        layout = job.run(spark, str(tmp_path / part), out, "parquet", (1, 12), threshold=50)
    assert {r[0] for r in job.read_monthly(spark, layout.monthly).select(S.MONTH).collect()} == {1, 2}
    q2 = scan_csv_report(spark, layout.report("q2"), S.labelled(S.Q2_SCHEMA, S.Q2_LABELS))
    expected = reports.q2_top_carriers(clean.filter("MONTH <= 2"), (1, 12), threshold=50)
    assert [tuple(r) for r in q2.collect()] == [tuple(r) for r in expected.collect()]


def test_an_incremental_run_replaces_its_months(spark, small_dir, clean, tmp_path):
    raw = flights(spark, small_dir)
    raw.filter("MONTH <= 3").write.parquet(str(tmp_path / "first"))
    raw.filter("MONTH BETWEEN 3 AND 4 AND OP_UNIQUE_CARRIER <> 'AA'").write.parquet(
        str(tmp_path / "second")
    )
    out = str(tmp_path / "out")
    job.run(spark, str(tmp_path / "first"), out, "parquet", stages=("clean", "refresh"))
    layout = job.run(
        spark, str(tmp_path / "second"), out, "parquet", replace="touched", stages=("clean", "refresh")
    )
    expected = clean.filter("MONTH <= 2 OR (MONTH <= 4 AND OP_UNIQUE_CARRIER <> 'AA')")
    stored = scan_partitioned(spark, layout.clean)
    assert stored.exceptAll(expected.select(*stored.columns)).count() == 0
    assert stored.count() == expected.count()
    q2 = reports.q2_from_states(job.read_monthly(spark, layout.monthly), threshold=20)
    assert q2.collect() == reports.q2_top_carriers(expected, threshold=20).collect()


def test_stages_run_alone(spark, small_dir, tmp_path, monkeypatch):
    flights(spark, small_dir).write.parquet(str(tmp_path / "raw"))
    out = str(tmp_path / "out")

    def stage(*options):
        monkeypatch.setattr(
            "sys.argv", ["job", str(tmp_path / "raw"), out, "--format", "parquet", *options]
        )
        job.main()

    layout = job.Layout(out)
    stage("--stages", "clean", "--no-rebalance")
    assert glob.glob(f"{layout.clean}/MONTH=*")
    assert not glob.glob(layout.monthly)
    stage("--stages", "refresh")
    assert glob.glob(f"{layout.delays}/MONTH=*")
    stage("--stages", "report", "--min-records", "50", "--percentiles", "interpolated")
    q3 = scan_csv_report(
        spark,
        layout.report("q3_percentiles"),
        S.labelled(S.Q3_PERCENTILES_SCHEMA, S.Q3_PERCENTILES_LABELS),
    )
    stored = scan_partitioned(spark, layout.clean)
    expected = reports.q3_percentiles(stored, method="interpolated")
    assert [tuple(r) for r in q3.collect()] == [tuple(r) for r in expected.collect()]
    assert not glob.glob(layout.records)
    stage("--stages", "export")
    assert read_keyed(spark, layout.records, "q1").count() == 8


def test_export_through_another_sink(spark, layout, tmp_path):
    path = str(tmp_path / "sink")
    job.export_reports(spark, layout, "json", {"path": path})
    assert spark.read.json(path).count() > 0


def test_input_that_cleaning_empties(spark, make_flights, tmp_path):
    make_flights({S.CARRIER: None}).write.parquet(str(tmp_path / "raw"))
    layout = job.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"), "parquet")
    assert reports.q1_from_states(job.read_monthly(spark, layout.monthly)).columns == S.Q1_SCHEMA.names
    for name, schema, headings in (
        ("q1", S.Q1_SCHEMA, S.Q1_LABELS),
        ("q2", S.Q2_SCHEMA, S.Q2_LABELS),
        ("q3_percentiles", S.Q3_PERCENTILES_SCHEMA, S.Q3_PERCENTILES_LABELS),
    ):
        back = scan_csv_report(spark, layout.report(name), S.labelled(schema, headings))
        assert back.count() == 0
    assert read_keyed(spark, layout.records, "q2").count() == 0


def test_the_export_has_every_row_of_the_report(spark, tmp_path):
    rows = [(f"C{i:02}", 100, float(i), 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(23)]
    report = labels.report_labels(spark.createDataFrame(rows, S.Q2_SCHEMA), S.Q2_LABELS)
    path = write_report_csv(report, str(tmp_path / "q2"))
    positions = records(exports.q2_records(spark, path))
    assert {r["compagnia"]: r["posizione"] for r in positions} == {f"C{i:02}": 23 - i for i in range(23)}


def test_export_fails_loudly(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        job.export_reports(spark, job.Layout(str(tmp_path)))


def test_states_refresh_month_by_month(spark, clean, tmp_path):
    layout = job.Layout(str(tmp_path))
    for first in (1, 3, 5):
        job.refresh_states(clean.filter(f"MONTH IN ({first}, {first + 1})"), layout, "touched")
    job.refresh_states(clean.filter("MONTH = 2"), layout, "touched")
    monthly, delays = job.read_monthly(spark, layout.monthly), job.read_delays(spark, layout.delays)
    assert monthly.columns == spark.read.parquet(layout.monthly).columns
    assert delays.schema == spark.read.parquet(layout.delays).schema
    q1 = reports.q1_from_states(monthly)
    assert q1.collect() == reports.q1_monthly_delay(clean).collect()
    q2 = reports.q2_from_states(monthly, threshold=100)
    assert q2.collect() == reports.q2_top_carriers(clean, threshold=100).collect()
    histogram = reports.q3_histogram_from_states(delays)
    q3 = reports.q3_percentiles_of(histogram)
    assert q3.collect() == reports.q3_percentiles(clean).collect()
    limits = reports.q3_min_max_of(histogram)
    assert limits.collect() == reports.q3_min_max(clean).collect()


def test_methods_of_q3_agree(clean):
    def by_key(method, **kwargs):
        rows = records(reports.q3_percentiles(clean, method=method, **kwargs))
        return {(r["carrier"], r["hour_bucket"]): r for r in rows}

    exact = by_key("discrete")
    assert by_key("approx", accuracy=1_000_000) == exact
    between = by_key("interpolated")
    assert between.keys() == exact.keys()
    # Neighbouring values bracket an interpolated one; medians of small groups differ.
    assert all(abs(between[k]["p50"] - exact[k]["p50"]) <= 60 for k in exact)


def test_cache_is_pruned_and_released(spark, clean):
    with cached(clean, [S.CARRIER, S.DEP_DELAY]) as kept:
        assert kept.columns == [S.CARRIER, S.DEP_DELAY]
        assert kept.storageLevel.useMemory
        assert kept.count() == 5761
    assert not kept.storageLevel.useMemory
    with pytest.raises(RuntimeError), cached(clean) as kept:
        raise RuntimeError
    assert not kept.storageLevel.useMemory


def test_clean_table_is_what_the_reports_read(spark, layout, clean):
    stored = scan_partitioned(spark, layout.clean)
    assert stored.exceptAll(clean.select(*stored.columns)).count() == 0
    assert stored.count() == clean.count()


def test_measure(clean, tmp_path):
    path = str(tmp_path / "report")
    timing = measure(lambda: reports.q3_min_max(clean), runs=3, report_path=path)
    assert len(timing.runs) == 3
    assert len(timing.warm) == 2
    assert timing.best <= timing.median
    assert timing.best <= timing.mean
    assert glob.glob(f"{path}/*.csv")
