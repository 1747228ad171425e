from __future__ import annotations

import pytest
from flight_records import records

from ontime import schema as S
from ontime.functions import composite_key
from ontime.operators import aggregates, labels, ranking, states
from ontime.operators.cleaning import clean_flights
from ontime.operators.filters import completed_filter
from ontime.plans import reports
from ontime.sources import flights


def test_group_of_cancelled_flights(make_flights):
    df = make_flights({S.CANCELLED: 1.0, S.DEP_DELAY: 5.0}, {S.CANCELLED: 1.0, S.DEP_DELAY: None})
    (row,) = records(reports.q1_monthly_delay(df))
    assert row == {
        "month": 1,
        "carrier": "AA",
        "dep_delay_mean": None,
        "dep_delay_min": None,
        "dep_delay_max": None,
        "cancellation_rate": 100.0,
    }
    state = states.delay_state(df, [S.CARRIER])
    (final,) = records(states.finalize_delay_state(state, [S.CARRIER]))
    assert (final["dep_delay_mean"], final["cancellation_rate"]) == (None, 100.0)


def test_q1_ignores_cancelled_delays(make_flights):
    df = make_flights(
        {S.DEP_DELAY: 10.0},
        {S.DEP_DELAY: -5.0},
        {S.DEP_DELAY: 900.0, S.CANCELLED: 1.0},
        {S.DEP_DELAY: 700.0, S.MONTH: 5},
        {S.DEP_DELAY: 700.0, S.CARRIER: "UA"},
    )
    (row,) = records(reports.q1_monthly_delay(df))
    assert list(row.values()) == [1, "AA", 2.5, -5.0, 10.0, 33.33]


def test_rate_of_nothing_is_null(make_flights):
    df = make_flights({}).limit(0)
    (row,) = records(aggregates.cancel_rate(df, []))
    assert row["cancellation_rate"] is None


def test_top_k_ties_are_decided_by_carrier(make_flights):
    rows = [{S.CARRIER: c, S.ARR_DELAY: d} for c, d in (("B", 5.0), ("A", 5.0), ("C", 9.0))]
    df = make_flights(*rows)
    top = records(reports.q2_top_carriers(df, threshold=1, k=2))
    assert [row["carrier"] for row in top] == ["C", "A"]
    board = ranking.leaderboard_rank(
        reports.q2_carriers(df, threshold=1), "arr_delay_mean", 3, "carrier"
    )
    assert [(r["position"], r["carrier"]) for r in records(board.orderBy("position"))] == [
        (1, "C"),
        (2, "A"),
        (3, "B"),
    ]


def test_threshold_counts_completed_flights_only(make_flights):
    df = make_flights({}, {}, {S.DIVERTED: 1.0, S.ARR_DELAY: None})
    assert reports.q2_carriers(df, threshold=2).count() == 1
    assert reports.q2_carriers(df, threshold=3).count() == 0


def test_states_lead_to_the_direct_results(spark, small_dir):
    df = clean_flights(flights(spark, small_dir))
    monthly = reports.monthly_state(df)
    q1 = reports.q1_from_states(monthly)
    assert q1.collect() == reports.q1_monthly_delay(df).collect()
    q2 = reports.q2_from_states(monthly, threshold=100)
    assert q2.collect() == reports.q2_top_carriers(df, threshold=100).collect()
    keys = [S.MONTH, S.CARRIER]
    sums = states.sum_state(completed_filter(df), keys, list(reports.Q2_MEANS))
    assert sums.exceptAll(monthly.select(*sums.columns)).count() == 0


def test_operators_take_any_table(spark, small_dir):
    orders = spark.read.parquet(f"{small_dir}/orders.parquet")
    got = aggregates.min_max(orders, ["o_orderstatus"], "o_totalprice", "price")
    assert got.columns == ["o_orderstatus", "price_min", "price_max"]
    assert got.count() == orders.select("o_orderstatus").distinct().count()


def test_unknown_heading_fails(make_flights):
    report = labels.report_labels(reports.q1_monthly_delay(make_flights({})), S.Q1_LABELS)
    assert report.columns == list(S.Q1_LABELS.values())
    with pytest.raises(ValueError, match="25th percentile"):
        labels.canonical_names(report, {"25th percentile": "percentile_25"})


def test_null_key_part_fails(spark):
    df = spark.createDataFrame([("DL", None)], "a string, b int")
    with pytest.raises(Exception, match="null part"):
        df.select(composite_key("a", "b")).collect()
