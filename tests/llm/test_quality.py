from __future__ import annotations

import random

import corpus_pipeline
import helpers

from ontime.llm import quality

FIELDS = "doc_id long, text string, source string, n_words string, kept string, host string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], FIELDS)


def test_signals_against_brute_force(spark):
    rnd = random.Random(4)
    texts = [None, "", " \t\n", "one", "a b c d e a b c d e", "x " * 5000, "#*$%&|<>" * 3]
    for _ in range(120):
        pieces = rnd.choices(["a", "b", "é$", "#", "\n", "\n\n", "  ", "\x0b", "\u00a0c"], k=rnd.randrange(60))
        texts.append(" ".join(pieces))
    texts.append("\n".join(["same line"] * 3 + ["other", "", " ", "same line "]))
    texts.append("z" * 200_000)
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in quality.quality_report(spark, documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        tokens = helpers.words(text)
        lines = [line for line in (text or "").split("\n") if helpers.words(line)]
        got = found[i]
        assert got.n_words == len(tokens)
        assert got.word_chars == sum(map(len, tokens))
        assert got.n_symbols == sum((text or "").count(c) for c in "#*$%&|<>")
        assert got.n_dup_lines == len(lines) - len(set(lines))
        assert got.n_repeat_words == helpers.repeat_words(tokens)
        failed = len(tokens) < 10 or 100 * got.n_repeat_words > 20 * len(tokens)
        assert got.base_failed == failed
        assert not (failed and got.kept)


def prose(rnd, n=40):
    return " ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(n))


def test_lines_of_many_documents_go_and_depleted_documents_are_rejected(spark):
    rnd = random.Random(5)
    banner = "Subscribe to  our NEWS letter today and every other day of the week please"
    other = banner.lower().replace("  ", " ")
    rows = [(i, f"{banner if i % 2 else other}\n{prose(rnd)}", "s") for i in range(30)]
    rows += [(100, f"{banner}\nonly three left", "s"), (101, banner, "elsewhere"), (102, banner, None)]
    docs = documents(spark, rows)
    kept = {r.doc_id: r for r in quality.quality_report(spark, docs).collect()}
    assert all(kept[i].kept for i in range(30))
    assert not kept[100].kept
    assert not kept[100].base_failed
    assert kept[101].kept
    assert kept[102].kept
    cleaned = quality.quality_documents(spark, docs)
    assert cleaned.columns == docs.columns
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts[3] == rows[3][1].split("\n")[1]
    assert texts[101] == banner
    assert 100 not in texts


def test_copies_do_not_make_their_lines_frequent(spark):
    rnd = random.Random(6)
    page = f"{prose(rnd)}\n{prose(rnd)}"
    rows = [(i, page, "s") for i in range(50)] + [(99 + i, prose(rnd), "s") for i in range(20)]
    report = quality.quality_report(spark, documents(spark, rows)).collect()
    assert all(r.kept for r in report)


def test_a_large_group_of_near_copies_keeps_one_document(spark):
    rnd = random.Random(7)
    banner = "Subscribe to our news letter today and every other day of the week"
    base = [prose(rnd, 10) for _ in range(20)]
    rows = []
    for i in range(80):
        changed = list(base)
        changed[i % 20] = f"n{i} " + base[i % 20].split(" ", 1)[1]
        rows.append((i, "\n".join([*changed, banner]), "s"))
    rows += [(100 + i, "\n".join([prose(rnd, 10), prose(rnd, 20), banner]), "s") for i in range(200)]
    docs = documents(spark, rows)
    report = {r.doc_id: r for r in quality.quality_report(spark, docs).collect()}
    assert all(r.kept for r in report.values())
    assert all(r.words_left == r.n_words - 13 for r in report.values())
    clean = corpus_pipeline.quality_stage(spark, docs, "")
    left = corpus_pipeline.near_duplicate_stage(spark, clean, "").select("doc_id", "text").collect()
    assert sorted(r.doc_id for r in left) == [0, *range(100, 300)]
    assert {r.doc_id: r.text for r in left}[0] == rows[0][1].removesuffix("\n" + banner)


def test_empty_table(spark):
    empty = documents(spark, [(1, "a", "s")]).where("false")
    assert quality.quality_report(spark, empty).collect() == []
    assert quality.quality_documents(spark, empty).columns == empty.columns
