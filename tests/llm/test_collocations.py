from __future__ import annotations

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from ontime.llm import collocations

SCHEMA = "doc_id long, text string, lang string"
ENDS = re.compile(r"[.,;:!?\x0A-\x0D]")


def expected(rows, min_count, kept):
    """All phrases of all pieces, counted and cut in plain Python."""
    counts: dict = collections.defaultdict(collections.Counter)
    totals: collections.Counter = collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in ENDS.split(lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    found = []
    for lang, count in counts.items():
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        scored = []
        for phrase, a in good.items():
            if len(phrase) == 2 and any(
                100 * b >= 50 * a and phrase in (longer[:2], longer[1:])
                for longer, b in good.items()
                if len(longer) == 3
            ):
                continue
            cuts = [
                (1_000_000 * a * a // (count[phrase[:k]] * count[phrase[k:]]), k)
                for k in range(1, len(phrase))
            ]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), count[phrase[:k]], count[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:kept], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in df.collect())


def corpus(seed, documents=300):
    """Random words, some of which like each other, cut into pieces."""
    draw = random.Random(seed)
    words = ["the", "The", "of", "New", "York", "city", "ça", "日本", "x\x00y", "\x85", " ", "e-mail", "#1"]
    words += [f"w{n}" for n in range(40)]
    phrases = [["new", "york", "city"], ["a", "b"], ["a", "b", "c"], ["q", "q", "q"], ["rare", "pair"]]
    rows = []
    for n in range(documents):
        text = []
        for _ in range(draw.randrange(0, 60)):
            text += draw.choice(phrases) if draw.random() < 0.2 else [draw.choice(words)]
            if draw.random() < 0.1:
                text.append(draw.choice([".", ",", "\n", "!", ":", "\x0b", "\t"]))
        rows.append((n, draw.choice([" ", "  ", " \t"]).join(text), draw.choice(["en", "en", "de", None, "und", "", "tiny"])))
    return rows


@pytest.mark.parametrize("kept, first_pairs", [(2000, 2), (15, 2), (5, 1), (40, 1)])
def test_same_as_counting_everything(spark, kept, first_pairs):
    rows = corpus(kept)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = collocations.collocations(spark, df, min_count=3, kept=kept, first_pairs=first_pairs)
    assert result(found) == expected(rows, 3, kept)


def test_many_rounds_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 300)
    monkeypatch.setattr(collocations, "SLICE_CHARS", 40)
    monkeypatch.setattr(collocations, "MORE_PAIRS", 2)
    monkeypatch.setattr(collocations, "BATCH_ROWS", 7)
    # Pairs that longer phrases supplant: none of the best pairs survives.
    rows = corpus(1, 120) + [(1000 + n, f"p{n % 50} q{n % 50} r{n % 50}", "en") for n in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = collocations.collocations(spark, df, min_count=2, kept=60, first_pairs=1)
    assert result(found) == expected(rows, 2, 60)


def test_ties_at_the_last_rank(spark):
    rows = [(n, f"left{n % 90} right{n % 90}", "en") for n in range(900)]
    found = collocations.collocations(spark, spark.createDataFrame(rows, SCHEMA), kept=20)
    assert result(found) == expected(rows, 10, 20)
    assert {row.score for row in found.collect()} == {1_000_000}


def test_nulls_empty_texts_and_columns_of_other_names(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " .,;\n", None), (None, "a b " * 30, None), (5, "x " * 50, "en")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit(1), "ids": F.lit("x"), "w1": F.lit(2)})
    found = collocations.collocations(spark, df)
    assert result(found) == expected(rows, 10, 2000)


def test_no_rows(spark):
    found = collocations.collocations(spark, spark.createDataFrame([], SCHEMA))
    assert result(found) == []


def test_products_beyond_64_bits(spark):
    rows = [(10**13, 3 * 10**13, 4 * 10**13), (10**14 - 1, 10**14 - 1, 10**14 - 1), (10, 10**13, 10**13)]
    df = spark.createDataFrame(rows, "a long, l long, r long").withColumn("s", collocations.score("a", "l", "r"))
    assert [row.s for row in df.collect()] == [10**6 * a * a // (x * y) for a, x, y in rows]
