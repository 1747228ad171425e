from __future__ import annotations

import pytest
from flight_records import records
from pyspark.sql import functions as F

from ontime import schema as S
from ontime.functions import default_cast, hour_bucket, round2, strict_cast
from ontime.operators import cleaning, filters
from ontime.sources import flights


def test_required_fields(make_flights):
    df = make_flights({}, *[{field: None} for field in S.REQUIRED_FIELDS], {S.DEP_DELAY: None})
    kept = records(cleaning.require_fields(df))
    assert [row[S.DEP_DELAY] for row in kept] == [0.0, None]


def test_required_field_must_exist(make_flights):
    with pytest.raises(ValueError, match="missing columns"):
        cleaning.require_fields(make_flights({}).drop(S.MONTH))


@pytest.mark.parametrize(
    ("override", "kept"),
    [
        ({S.ARR_DELAY: 3.0}, True),
        ({S.ARR_DELAY: None}, False),
        ({S.ARR_DELAY: None, S.CANCELLED: 1.0}, True),
        ({S.ARR_DELAY: None, S.DIVERTED: 1.0}, True),
        ({S.DEP_DELAY: None}, False),
        ({S.DEP_DELAY: None, S.CANCELLED: 1.0}, True),
        # A diverted flight has left, so its departure delay is known.
        ({S.DEP_DELAY: None, S.DIVERTED: 1.0}, False),
    ],
)
def test_missing_delays_need_an_explanation(make_flights, override, kept):
    assert cleaning.clean_flights(make_flights(override)).count() == kept


@pytest.mark.parametrize(
    ("arrival", "cause", "expected"),
    [
        (15.0, 7.0, 7.0),
        (14.0, 7.0, 0.0),
        (14.0, None, 0.0),
        (15.0, None, 0.0),
        # Without an arrival delay a reported cause stays.
        (None, 7.0, 7.0),
        (None, None, 0.0),
    ],
)
def test_causes(make_flights, arrival, cause, expected):
    df = make_flights({S.ARR_DELAY: arrival} | dict.fromkeys(S.CAUSES, cause))
    (row,) = records(cleaning.normalize_causes(df))
    assert {row[c] for c in S.CAUSES} == {expected}


def test_clean_invariants(spark, small_dir):
    df = cleaning.clean_flights(flights(spark, small_dir))
    unexplained = (
        (F.col(S.ARR_DELAY).isNull() & (F.col(S.CANCELLED) != 1) & (F.col(S.DIVERTED) != 1))
        | (F.col(S.DEP_DELAY).isNull() & (F.col(S.CANCELLED) != 1))
    )
    causes = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in S.CAUSES]
    short = F.count(F.when((F.col(S.ARR_DELAY) < 15) & (F.col(S.CAUSES[0]) != 0), 1))
    (row,) = records(
        df.agg(F.count(F.when(unexplained, 1)).alias("u"), short.alias("s"), *causes)
    )
    assert set(row.values()) == {0}
    assert df.count() == 5761


def test_cleaning_twice_changes_nothing(spark, small_dir):
    once = cleaning.clean_flights(flights(spark, small_dir))
    twice = cleaning.clean_flights(once)
    assert once.exceptAll(twice).count() == 0
    assert twice.exceptAll(once).count() == 0


def test_empty_input_keeps_its_schema(make_flights):
    df = cleaning.clean_flights(make_flights({}).limit(0))
    assert df.count() == 0
    assert df.columns == S.FLIGHT_SCHEMA.names


def test_hour_bucket(spark):
    df = spark.createDataFrame([(t,) for t in (0, 59, 100, 1359, 2359, 2400)], "t int")
    assert [r.h for r in df.select(hour_bucket("t").alias("h")).collect()] == [
        0,
        0,
        1,
        13,
        23,
        24,
    ]


def test_round2_ties_go_away_from_zero(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (0.125,), (-0.125,), (None,)], "x double")
    got = [r.y for r in df.select(round2("x").alias("y")).collect()]
    assert got == [2.68, 1.01, 0.13, -0.13, None]


def test_casts(spark):
    df = spark.createDataFrame([("1.50",), (None,)], "x string")
    assert [r.y for r in df.select(default_cast("x").alias("y")).collect()] == [1.5, 0.0]
    with pytest.raises(Exception, match="missing value"):
        df.select(strict_cast("x")).collect()


@pytest.mark.parametrize("cast", [strict_cast, default_cast])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_fails_with_and_without_ansi(spark, cast, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|no number"):
            spark.createDataFrame([("x",)], "x string").select(cast("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


FLAG_ROWS = [
    # cancelled, diverted, carrier, completed, operated
    ("0.0", "0.0", "AA", True, True),
    ("0", " 0 ", "AA", True, True),
    ("1.00", "0", "AA", False, False),
    ("0", "1", "AA", False, True),
    ("x", "0", "AA", False, False),
    ("0", "x", "AA", False, True),
    (None, "0", "AA", True, True),
    ("0", None, "AA", False, True),
    ("0", "0", "", False, False),
    ("0", "0", None, False, False),
    ("0", "0", "ZZ", True, False),
]


def test_lenient_flags(spark):
    df = spark.createDataFrame(
        [(i, *row[:3]) for i, row in enumerate(FLAG_ROWS)],
        f"i int, {S.CANCELLED} string, {S.DIVERTED} string, {S.CARRIER} string",
    )
    completed = {r.i for r in filters.lenient_completed_filter(df).collect()}
    operated = {r.i for r in filters.lenient_operated_filter(df, ["AA"]).collect()}
    assert completed == {i for i, row in enumerate(FLAG_ROWS) if row[3]}
    assert operated == {i for i, row in enumerate(FLAG_ROWS) if row[4]}


def test_line_items_with_nulls_stay(spark, tmp_path):
    """Only the cleaning rules drop records, not the derivation of flights."""
    rows = [
        (1, 1, 1, 1, "1998-03-04"),
        (None, 1, 1, 1, "1998-03-04"),
        (1, None, 1, 1, "1998-03-04"),
        (1, 1, None, 1, "1998-03-04"),
        (1, 1, 1, None, "1998-03-04"),
        (1, 1, 1, 1, None),
    ]
    kinds = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, day string"
    items = spark.createDataFrame(rows, kinds)
    items.selectExpr("*", "CAST(day AS DATE) AS l_shipdate").write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    raw = flights(spark, str(tmp_path))
    assert raw.count() == 6
    months = [r["MONTH"] for r in records(raw)]
    assert sorted(m or 0 for m in months) == [0, 3, 3, 3, 3, 3]
    assert cleaning.clean_flights(raw).count() == cleaning.clean_flights(raw).filter("MONTH IS NOT NULL").count()
