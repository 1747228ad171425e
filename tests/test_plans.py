"""Physical plans: what reaches the scan, what is shuffled, what stays in the JVM."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.catalog import QUERIES
from ontime.operators import quantiles, ranking
from ontime.operators.cleaning import clean_flights, require_fields
from ontime.operators.reuse import cached
from ontime.plans import job, reports
from ontime.sinks import write_partitioned
from ontime.sources import flights, scan_partitioned


@pytest.fixture(scope="module")
def stored(spark, small_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans") / "clean")
    write_partitioned(clean_flights(flights(spark, small_dir)), folder)
    return scan_partitioned(spark, folder)


def plan(df) -> str:
    """The formatted plan before it runs."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def read_columns(text: str) -> set[str]:
    (schema,) = set(re.findall(r"ReadSchema: struct<(.*?)>", text))
    return {field.split(":")[0] for field in schema.split(",")}


def test_q1_reads_three_columns_of_four_months(stored):
    text = plan(reports.q1_monthly_delay(stored))
    assert read_columns(text) == {S.CARRIER, S.CANCELLED, S.DEP_DELAY}
    assert re.search(r"PartitionFilters: \[.*MONTH#\d+ >= 1.*MONTH#\d+ <= 4", text)
    assert "In(OP_UNIQUE_CARRIER, [AA,DL])" in text


def test_q2_is_one_shuffle_and_a_merged_top_k(stored):
    df = reports.q2_top_carriers(stored)
    text = plan(df)
    assert "TakeOrderedAndProject" in text
    assert "EqualTo(CANCELLED,0.0)" in text
    assert "EqualTo(DIVERTED,0.0)" in text
    assert final_plan(df).count("Exchange ") == 1
    assert "partial_avg" in text


def test_q3_pushes_its_filters(stored):
    text = plan(reports.q3_histogram(stored))
    assert "EqualTo(CANCELLED,0.0)" in text
    assert "In(OP_UNIQUE_CARRIER, [AA,DL,UA,WN])" in text
    assert read_columns(text) == {S.CARRIER, S.CANCELLED, S.DEP_DELAY, S.SCHEDULED_DEPARTURE}


def test_exact_percentiles_shuffle_counts_by_group_and_value(stored):
    by = [F.col(S.CARRIER)]
    counts = quantiles._celled(quantiles.value_histogram(stored, [S.CARRIER]), by, S.DEP_DELAY, "n")
    text = final_plan(quantiles._first_targets(counts, by, ["1"]))
    assert "partial_count(1)" in text
    # Next to the scan: counts by group and value.
    lines = text.splitlines()
    (scan,) = [i for i, line in enumerate(lines) if "FileScan" in line]
    nearest = [line for line in lines[:scan] if " Exchange " in line][-1]
    assert re.search(r"hashpartitioning\(OP_UNIQUE_CARRIER#\d+, DEP_DELAY#\d+, 8\)", nearest)
    # Values are added up cell by cell before they are shuffled again.
    assert re.search(r"hashpartitioning\(OP_UNIQUE_CARRIER#\d+, _cell#\d+L", text)
    assert "partial_min(_value" in text


def test_values_of_few_open_cells_stay_where_they_are(spark):
    """A cell that holds most of a group is not brought to one task."""
    values = spark.range(1000).selectExpr("id AS _value", "1 AS _n", "id % 1 + 7 AS _cell")
    cells = spark.createDataFrame([(7, 0, 999, 1000, 0)], "_cell long, _low long, _high long, _rows long, _new long")
    text = final_plan(quantiles._rows_of(values, cells, ["_cell"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_touched_months_prune_directories_at_run_time(spark, stored, tmp_path):
    layout = job.Layout(str(tmp_path))
    job.clean_table(stored, layout)
    stored.where("MONTH IN (3, 4)").write.parquet(str(tmp_path / "raw"))
    touched = job.touched_months(spark, str(tmp_path / "raw"), "parquet", layout)
    assert "dynamicpruning" in plan(touched)
    assert {row[0] for row in touched.select(S.MONTH).distinct().collect()} == {3, 4}
    assert touched.count() == stored.where("MONTH IN (3, 4)").count()


def test_both_state_tables_come_from_one_scan(stored):
    with cached(reports.monthly_detail(stored)) as detail:
        for states in (reports.monthly_of(detail), reports.delays_of(detail)):
            text = states._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in text
            assert text.count("FileScan") == 1


def test_a_rank_over_all_rows_has_many_tasks(spark):
    rows = spark.range(10_000).selectExpr("id AS name", "id % 100 AS points")
    ranked = ranking.rank_all(rows, "points", "name", partitions=7)
    assert "SinglePartition" not in plan(ranked.drop("position"))
    assert ranked.select(F.spark_partition_id()).distinct().count() > 1
    expected = sorted((-(n % 100), n) for n in range(10_000))
    found = ranked.orderBy("position").collect()
    assert [(r.position, -r.points, r.name) for r in found] == [(i, p, n) for i, (p, n) in enumerate(expected, 1)]


def test_required_fields_reach_the_scan(stored):
    text = plan(require_fields(stored))
    for field in (S.CARRIER, S.SCHEDULED_DEPARTURE, S.CANCELLED, S.DIVERTED):
        assert f"IsNotNull({field})" in text


def test_cleaning_does_not_shuffle(spark, small_dir):
    assert "Exchange" not in plan(clean_flights(flights(spark, small_dir)))


def test_cache_holds_the_named_columns_only(stored):
    with cached(stored, [S.CARRIER, S.DEP_DELAY]) as kept:
        text = final_plan(kept.groupBy(S.CARRIER).count())
    relation = re.search(r"InMemoryRelation \[(.*?)\]", text)
    assert {c.split("#")[0].strip() for c in relation[1].split(",")} == {S.CARRIER, S.DEP_DELAY}


@pytest.mark.parametrize("name", QUERIES)
def test_plan_of_every_query(name, spark, small_dir):
    df = QUERIES[name](spark, small_dir)
    text = plan(df)
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert operator not in text
    # Methods above 8000 bytes stay interpreted in the JVM, ten times slower.
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    code = getattr(getattr(debug, "package$"), "MODULE$").codegenStringSeq(
        df._jdf.queryExecution().executedPlan()
    )
    sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    assert max(sizes, default=0) < 8000
