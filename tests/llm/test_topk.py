from __future__ import annotations

import math
import random

import pytest

from ontime.llm import topk

FIELDS = "vec_id long, embedding array<float>, length string, block string"


def expected(rows, k, step):
    usable = []
    for vec_id, vector, *_ in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((vec_id, [math.floor(64 * x) for x in vector]))
    result = []
    for query in sorted({i for i, _ in usable if i is not None and i % step == 0}):
        asking = min(v for i, v in usable if i == query)
        scores = [
            (-sum(a * b for a, b in zip(asking, v, strict=True)), i is None, i)
            for i, v in usable
            if i != query and len(v) == len(asking)
        ]
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        result += [(query, n, i, -s) for n, (s, _, i) in enumerate(scores[:k], 1)]
    return result


def search(spark, rows, k=20, step=20):
    vectors = topk.quantised(spark.createDataFrame([(i, v, "x", "y") for i, v in rows], FIELDS))
    found = topk.exact_top_k(spark, vectors, vectors.where(f"vec_id % {step} = 0"), k)
    return sorted(tuple(r) for r in found.collect())


def f32(x):
    import numpy as np

    return float(np.float32(x))


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(topk, "QUERY_BLOCK_ROWS", 9)
    monkeypatch.setattr(topk, "BUCKET_ROWS", 16)
    monkeypatch.setattr(topk, "START_ROWS", 40)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(400):
        size = rnd.choice([0.01, 1, 1, 30]) if seed else 1.0
        spread = 0.05 if seed == 2 else 1.0
        rows.append((i, [f32(size * (c + spread * rnd.gauss(0, 1))) for c in rnd.choice(centres)]))
    if seed == 3:
        rows += [(1000 + i, rows[0][1]) for i in range(100)]
    assert search(spark, rows) == expected(rows, 20, 20)


def test_rows_that_take_no_part_and_few_candidates(spark):
    rows = [
        (0, [1.0, 2.0]),
        (0, [1.0, 2.0]),
        (1, None),
        (2, []),
        (3, [1.0, None]),
        (4, [1.0, float("nan")]),
        (5, [1.0, float("inf")]),
        (6, [-1.0, 0.5]),
        (7, [1.0, 2.0, 3.0]),
        (None, [1.0, 2.0]),
        (8, [1.0, 2.0]),
        (20, [0.0, 0.0]),
        (40, [1.0, 2.0, 3.0, 4.0]),
    ]
    assert search(spark, rows) == expected(rows, 20, 20)


def test_large_components_stay_exact(spark):
    rows = [(i, [f32(2.0**24 + i * 2), f32(2.0**23 - i)]) for i in range(60)]
    assert search(spark, rows) == expected(rows, 20, 20)


def test_empty_table(spark):
    assert search(spark, [(1, [1.0])], step=20) == []
    vectors = topk.quantised(spark.createDataFrame([], FIELDS))
    assert topk.exact_top_k(spark, vectors, vectors).collect() == []


def test_every_finite_double_is_floored(spark):
    values = [1e300, 3e18, 2.0**57, 2.0**53 / 64 - 0.3, -(2.0**60) - 512, -1e-9, 0.0, -0.51, 123456.789]
    df = spark.createDataFrame([(1, values)], "vec_id long, embedding array<double>")
    (row,) = topk.quantised(df).collect()
    assert [int(x) for x in row.vector] == [math.floor(64 * x) for x in values]


def test_scores_beyond_64_bits_end_the_job(spark):
    rows = [(i, [3e18 + i * 1e16, 1.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.quantised(df)
    with pytest.raises(Exception, match="(?i)int too"):
        topk.exact_top_k(spark, vectors, vectors).collect()


def test_blocks_too_short_for_all_queries_are_not_sent(spark, monkeypatch):
    """Of vectors of spread lengths most blocks meet no block of queries."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK_ROWS", 10)
    monkeypatch.setattr(topk, "START_ROWS", 60)
    rnd = random.Random(9)
    rows = [(i, [f32(2.0 ** -(i // 50) * rnd.uniform(0.5, 1)) for _ in range(4)]) for i in range(1000)]
    vectors = topk.quantised(spark.createDataFrame([(i, v, "x", "y") for i, v in rows], FIELDS), scale=2**20)
    sent = []
    pairs = topk.useful_pairs

    def counted(stored, asked):
        found = pairs(stored, asked)
        sent.append((found.count(), stored.select("block").distinct().count() * asked.select("query_block").distinct().count()))
        return found

    monkeypatch.setattr(topk, "useful_pairs", counted)
    found = topk.exact_top_k(spark, vectors, vectors.where("vec_id % 20 = 0"), 20)
    usable = {i: [math.floor(2**20 * x) for x in v] for i, v in rows}
    for query in (0, 500, 980):
        scores = sorted((-sum(a * b for a, b in zip(usable[query], v)), i) for i, v in usable.items() if i != query)
        got = found.where(f"query_id = {query}").orderBy("rank").collect()
        assert [(-r.score, r.vec_id) for r in got] == scores[:20]
    ((useful, every),) = sent
    assert useful < every / 3
