from __future__ import annotations

import random

import helpers
import pytest
from pyspark.sql import functions as F

from ontime.llm import mixing

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, target string, hash long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "x", 1) for i, t, s in rows], FIELDS)


def sizes_by_source(rows):
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(helpers.words(text))
    return sizes


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken_words(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (i, "w " * rnd.randrange(30), rnd.choice(["a", "b", "Z", "é", None, "c", "c", "c"][: 4 + 2 * seed]))
        for i in range(400)
    ]
    rows += [(1000, None, "a"), (1001, "", "empty"), (1002, "one", "small")]
    expected = helpers.targets(sizes_by_source(rows))
    found = mixing.mix(spark, documents(spark, rows)).collect()
    assert len(found) == len(rows)
    source = {i: s for i, _, s in rows}
    taken: dict = {}
    for row in found:
        assert row.target == pytest.approx(float(expected[source[row.doc_id]]), rel=1e-12)
        assert row.taken <= 3 * row.size
        assert row.size == 0 or row.taken % row.size == 0
        taken[source[row.doc_id]] = taken.get(source[row.doc_id], 0) + row.taken
    # No source is further from its target than half of its largest document.
    for name, words in taken.items():
        assert abs(words - expected[name]) <= 15
    assert sorted(mixing.mix(spark, documents(spark, rows)).collect()) == sorted(found)


def test_equal_rows_go_together_and_nothing_is_lost(spark):
    rows = [(7, "a b c", "s")] * 40 + [(None, "a b", None), (None, None, None)]
    found = mixing.mix(spark, documents(spark, rows)).collect()
    assert len(found) == 42
    assert len({row.taken for row in found if row.doc_id == 7}) == 1


def test_a_very_long_text_is_counted_whole(spark):
    rows = [(1, "w\t" * 700_000, "s"), (2, "x" * 900_000, "s"), (3, "a b", "t")]
    found = {r.doc_id: r for r in mixing.mix(spark, documents(spark, rows)).collect()}
    assert {k: r.size for k, r in found.items()} == {1: 700_000, 2: 1, 3: 2}
    assert {k: r.source_size for k, r in found.items()} == {1: 700_001, 2: 700_001, 3: 2}


def test_empty_table(spark):
    empty = documents(spark, [(1, "x", "s")]).where("false")
    assert mixing.mix(spark, empty).collect() == []
    assert mixing.mixed_documents(spark, empty).columns == empty.columns


def test_documents_keep_their_columns_and_come_as_often_as_taken(spark):
    rows = [(i, "w " * (1 + i % 5), "big" if i % 4 else "tiny") for i in range(60)]
    docs = documents(spark, rows)
    mixed = mixing.mixed_documents(spark, docs)
    assert mixed.columns == docs.columns
    counts = dict(mixed.groupBy("doc_id").count().collect())
    for row in mixing.mix(spark, docs).collect():
        assert counts.get(row.doc_id, 0) * row.size == row.taken


def test_a_smaller_budget_takes_part_of_what_a_larger_one_takes(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 7), "s") for i in range(300)])
    sizes = mixing.sized(docs)
    taken = []
    for share in (0.2, 0.5, 0.9):
        total = sizes.agg(F.sum("size")).first()[0]
        targets = spark.createDataFrame([("s", total, 0, share * total)], "source string, source_size long, position int, target double")
        plan = mixing.thresholds(sizes, targets)
        chosen = sizes.join(plan, F.col("source") == F.col("p_source")).where(mixing.copies() > 0)
        taken.append({row.doc_id for row in chosen.collect()})
    assert taken[0] < taken[1] < taken[2]
