from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ontime.llm import exact_dedup

SCHEMA = "doc_id long, text string"


def expected(rows, largest=True):
    best: dict = {}
    sizes: dict = {}
    for key, text in rows:
        text = text or ""
        sizes[text] = sizes.get(text, 0) + 1
        known = best.get(text)
        if known is None or (key is not None and (key > known if largest else key < known)):
            best[text] = key
    return sorted(
        (
            (key, best[text or ""], sizes[text or ""], hashlib.sha256((text or "").encode()).hexdigest())
            for key, text in rows
        ),
        key=repr,
    )


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("fanout, range_rows", [(2, 50), (8, 1_000_000), (3, 100)])
def test_classes_of_many_partitions(spark, keep, fanout, range_rows):
    draw = random.Random(7)
    texts = [None, "", " ", "a", "A", "é", "é", *("w" * n for n in range(200))]
    rows = [(n, draw.choice(texts)) for n in range(1500)] + [(2000 + n, "hot") for n in range(900)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(13)
    found = exact_dedup.exact_duplicates(spark, df, keep=keep, fanout=fanout, range_rows=range_rows)
    assert result(found) == expected(rows, keep == "largest")
    kept = [r.doc_id for r in found.where("kept").collect()]
    assert sorted(kept) == sorted({k for _, k, _, _ in expected(rows, keep == "largest")})


def test_a_class_beyond_the_limit_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_HOT", 5)
    rows = [(n, "same") for n in range(30)] + [(100 + n, f"pair {n // 2}") for n in range(10)]
    found = exact_dedup.exact_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert result(found) == expected(rows)


def test_rows_that_repeat_and_null_keys(spark):
    rows = [(1, "x"), (1, "x"), (None, "x"), (None, "n"), (None, "n"), (4, None), (5, "")]
    found = exact_dedup.exact_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert result(found) == expected(rows)
    kept = sorted(((r.doc_id, r.text_sha256[:4]) for r in found.where("kept").collect()), key=repr)
    assert len(kept) == 3
    assert [k for k, _ in kept] == [1, 5, None]


def test_no_rows(spark):
    found = exact_dedup.exact_duplicates(spark, spark.createDataFrame([], SCHEMA))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert found.collect() == []


def test_a_rule_that_makes_texts_equal(spark):
    rows = [(1, "A  b"), (2, "a b"), (3, "ab")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = exact_dedup.exact_duplicates(
        spark, df, normalise=lambda t: F.lower(F.regexp_replace(t, " +", " "))
    )
    assert {(r.doc_id, r.keep_id) for r in found.collect()} == {(1, 2), (2, 2), (3, 3)}


def test_documents_that_stay_keep_their_columns(spark):
    long_text = "word " * 400_000
    rows = [(1, "x", "p", 1), (2, "x", "q", 2), (3, long_text, None, 3), (2, long_text, "r", 4), (2, "x", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string, digest long")
    left = exact_dedup.without_copies(spark, df)
    assert left.columns == df.columns
    found = sorted((r.doc_id, len(r.text), r.digest in (2, 5)) for r in left.collect())
    assert found == [(2, 1, True), (3, len(long_text), False)]


def test_a_run_is_folded_across_batches():
    columns = ["head", "digest", "n_bytes", "check", "keep_id", "keep_row", "size"]
    rows = [(0, d, 1, 1, k, k, 1) for k, d in enumerate([b"a", b"a", b"b", b"b", b"b", b"c"])]
    batches = [
        pa.RecordBatch.from_pylist([dict(zip(columns, row, strict=True)) for row in rows[a : a + 2]])
        for a in (0, 2, 4)
    ]
    empty = batches[0].slice(0, 0)
    folded = pa.Table.from_batches(list(exact_dedup.fold(iter([empty, *batches]))))
    assert [(r["digest"], r["keep_id"], r["size"]) for r in folded.to_pylist()] == [
        (b"a", 0, 2),
        (b"b", 2, 3),
        (b"c", 5, 1),
    ]
