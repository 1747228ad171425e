from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pytest
from flight_records import records

from ontime import schema as S
from ontime.operators import quantiles as Q
from ontime.operators.cleaning import clean_flights
from ontime.sources import flights

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
NAMES = ("p0", "p10", "p25", "p50", "p75", "p90", "p100")


def brute_discrete(values, prob):
    ranked = sorted(values)
    rank = max(math.ceil(Decimal(str(prob)) * len(ranked)), 1)
    return ranked[rank - 1]


def groups_of(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


def random_groups():
    rng = np.random.default_rng(7)
    return {
        "minutes": [float(x) for x in rng.integers(-60, 300, 997)],
        "continuous": [float(x) for x in rng.normal(0, 40, 1000)],
        "heavy tail": [float(x) for x in rng.pareto(0.5, 500)],
        "fractions": [float(x) for x in rng.uniform(-1e-3, 1e-3, 700)],
        "one value": [3.5] * 100,
        "single": [-0.25],
        "pair": [1.0, 2.0],
        None: [float(x) for x in range(11)],
    }


@pytest.mark.parametrize(
    "cells, parts, few, broadcast",
    [(1, 2, 1, 0), (1, 7, 20, 100), (64, 3, 5, 100), (4096, 65_536, 10_000, 100_000)],
)
def test_exact_percentiles_against_brute_force(spark, monkeypatch, cells, parts, few, broadcast):
    monkeypatch.setattr(Q, "CELLS_PER_OCTAVE", cells)
    monkeypatch.setattr(Q, "PARTS", parts)
    monkeypatch.setattr(Q, "FEW_VALUES", few)
    monkeypatch.setattr(Q, "BROADCAST_CELLS", broadcast)
    groups = random_groups()
    df = groups_of(spark, groups)
    discrete = Q.percentiles_discrete(df, ["g"], "v", PROBS, NAMES)
    between = Q.percentiles_interpolated(df, ["g"], "v", PROBS, NAMES)
    discrete, between = ({r["g"]: r for r in records(d)} for d in (discrete, between))
    assert discrete.keys() == between.keys() == groups.keys()
    for g, values in groups.items():
        for prob, name in zip(PROBS, NAMES, strict=True):
            assert discrete[g][name] == brute_discrete(values, prob), (g, name)
            expected = float(np.quantile(values, prob))
            assert between[g][name] == pytest.approx(expected, rel=1e-9, abs=1e-9), (g, name)


def test_without_keys(spark):
    df = groups_of(spark, {"a": [float(x) for x in range(101)]})
    (row,) = records(Q.percentiles_discrete(df, [], "v"))
    assert row == {"p25": 25.0, "p50": 50.0, "p75": 75.0, "p90": 90.0}


def test_nulls_are_not_values_but_their_groups_stay(spark):
    df = groups_of(spark, {"a": [None, 1.0, None, 3.0], "b": [None, None]})
    got = {r["g"]: r for r in records(Q.percentiles_discrete(df, ["g"], "v"))}
    assert [got["a"][n] for n in ("p25", "p50", "p75", "p90")] == [1.0, 1.0, 3.0, 3.0]
    assert [got["b"][n] for n in ("p25", "p50", "p75", "p90")] == [None] * 4


def test_extreme_values_keep_their_order(spark):
    tiny, huge = 5e-324, 1.7976931348623157e308
    up = [tiny, 1e-3, 1.0, 2.0, 1e300, huge, math.inf]
    values = [*[-v for v in reversed(up)], 0.0, *up, math.nan]
    df = groups_of(spark, {"a": values})
    probs = [(i + 1) / 16 for i in range(16)]
    names = [f"p{i}" for i in range(16)]
    (row,) = records(Q.percentiles_discrete(df, ["g"], "v", probs, names))
    got = [row[n] for n in names]
    assert got[:15] == values[:15]
    assert math.isnan(got[15])


def test_whole_numbers(spark):
    """Longs beyond the precision of doubles keep their order and type."""
    values = [2**60 + i for i in range(1, 6)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    (row,) = records(Q.percentiles_discrete(df, [], "v", [0.2, 0.6, 1.0], ["a", "b", "c"]))
    assert list(row.values()) == [values[0], values[2], values[4]]


def test_dense_points_in_time_of_one_day(spark):
    """A group of one day's times is split until few remain; no task orders them all."""
    n = 400_000
    times = spark.range(n).selectExpr(
        "timestamp_micros(1700000000000000 + (id * 7919 % 400000) * 216000 + id % 3) AS t"
    )
    (row,) = records(Q.percentiles_discrete(times, [], "t", PROBS, NAMES))
    ordered = sorted(r.t for r in times.collect())
    for prob, name in zip(PROBS, NAMES, strict=True):
        assert row[name] == ordered[max(math.ceil(Decimal(str(prob)) * n), 1) - 1], name


def test_values_that_no_double_separates(spark, monkeypatch):
    monkeypatch.setattr(Q, "FEW_VALUES", 3)
    df = spark.range(100).selectExpr("id + 4611686018427387904 AS v")
    (row,) = records(Q.percentiles_discrete(df, [], "v", [0.01, 0.5, 1.0], ["a", "b", "c"]))
    assert [v - 2**62 for v in row.values()] == [0, 49, 99]


def test_merged_histograms_equal_the_whole(spark, small_dir):
    df = clean_flights(flights(spark, small_dir))
    fine = Q.value_histogram(df, [S.MONTH, S.CARRIER])
    merged = Q.merge_histogram(fine, [S.CARRIER])
    expected = sorted(Q.percentiles_discrete(df, [S.CARRIER]).collect())
    for histogram in (merged, fine):
        got = Q.percentiles_from_histogram(histogram, [S.CARRIER])
        assert sorted(got.collect()) == expected


@pytest.mark.parametrize("merge", [False, True])
def test_sketch_counts_exactly_and_stays_within_bound(spark, small_dir, merge):
    df = clean_flights(flights(spark, small_dir))
    keys = [S.CARRIER]
    if merge:
        sketch = Q.merge_sketch(Q.quantile_sketch(df, [S.MONTH, *keys], k=1000), keys, k=1000)
    else:
        sketch = Q.quantile_sketch(df, keys, k=1000)
    error = Q.rank_error(
        Q.value_histogram(df, keys), Q.read_sketch(sketch, keys), keys, carry=["n"]
    )
    rows = records(error)
    assert len(rows) == 13
    assert all(r["n"] == r["present"] and r["rank_error"] <= 0.02 for r in rows)


def test_sketch_of_nothing(spark):
    df = groups_of(spark, {"a": [None, None], "b": [1.0]})
    got = {r["g"]: r for r in records(Q.read_sketch(Q.quantile_sketch(df, ["g"], "v"), ["g"]))}
    assert (got["a"]["n"], got["a"]["p50"]) == (0, None)
    assert (got["b"]["n"], got["b"]["p50"]) == (1, 1.0)


def test_rank_error_measures_the_distance(spark):
    df = groups_of(spark, {"a": [float(x) for x in range(1, 101)]})
    histogram = Q.value_histogram(df, ["g"], "v")
    for estimate, expected in ((50.0, 0.0), (60.0, 0.09), (30.0, 0.2)):
        given = spark.createDataFrame([("a", estimate)], "g string, p50 double")
        (row,) = records(Q.rank_error(histogram, given, ["g"], "v", [0.5], ["p50"]))
        assert row["rank_error"] == pytest.approx(expected)
