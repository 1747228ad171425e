"""Quality rules: signals of a text, and lines that many documents of a host share.

Lines are normalised and hashed; a line found in more than a share of a
host's distinct documents is furniture of the site and is removed. A document
that fails a base rule, or of which removal leaves little, is rejected.

Documents are counted by the hash of their text, so copies of one page do not
turn its own lines into furniture. Nor do near copies: texts of which the lines
above the limit would leave too little count as one for each of these lines,
and the limit is applied again. A line above the limit takes up at least
its share of a host's lines, so at most `lines per document / share` lines of
a host can be above it: the list that is sent to the texts is bounded per host.

Defined results: null text has no words and fails; null is a host of its own;
repeated rows each have their result; an empty table gives an empty result;
lines without a word are neither counted nor removed; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import BLANK_RUN, broadcast_if_small, let, materialise, stripped, words

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Limits of the cross-document rule.
MAX_LINE_PERCENT = 10
MIN_LINE_DOCUMENTS = 10
MIN_LEFT_PERCENT = 20


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def has_word(line: Column) -> Column:
    return stripped(line) != ""


def line_hash(line: Column) -> Column:
    """Hash of a line without case, outer white space and its exact inner one."""
    return F.xxhash64(F.lower(F.regexp_replace(stripped(line), BLANK_RUN, " ")))


def covered_words(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more.

    Sorted by hash, equal windows are neighbours. Their starts, in order, each
    add the words up to the next start, or a whole window.
    """

    def positions(pairs: Column) -> Column:
        repeated = F.filter(
            pairs,
            lambda pair, i: F.coalesce(F.get(pairs, i - 1)["hash"] == pair["hash"], F.lit(False))
            | F.coalesce(F.get(pairs, i + 1)["hash"] == pair["hash"], F.lit(False)),
        )
        return F.array_sort(F.transform(repeated, lambda pair: pair["at"]))

    def union(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda start, i: F.least(
                F.lit(WINDOW_WORDS), F.coalesce(F.get(starts, i + 1) - start, F.lit(WINDOW_WORDS))
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    pairs = F.array_sort(
        F.transform(windows, lambda value, i: F.struct(value.alias("hash"), i.alias("at")))
    )
    return let(pairs, lambda p: let(positions(p), union))


def repeat_words(tokens: Column) -> Column:
    def windows(hashes: Column) -> Column:
        starts = F.when(
            F.size(hashes) >= WINDOW_WORDS, F.sequence(F.lit(0), F.size(hashes) - WINDOW_WORDS)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW_WORDS)))
        )

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(
            covered_words(found)
        )

    hashes = F.transform(tokens, lambda word: F.xxhash64(word))
    return let(hashes, lambda h: let(windows(h), count))


def base_signals(text: Column) -> Column:
    """All signals of one text as a struct, with the words split once."""
    wordy = F.filter(lines(text), has_word)
    symbols = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SYMBOLS}]+", "")
    return let(
        words(text),
        lambda tokens: F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.char_length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            F.char_length(symbols).cast("long").alias("n_symbols"),
            let(wordy, lambda w: F.size(w) - F.size(F.array_distinct(w)))
            .cast("long")
            .alias("n_dup_lines"),
            repeat_words(tokens).cast("long").alias("n_repeat_words"),
        ),
    )


def base_failed(signals: Column) -> Column:
    return (signals["n_words"] < MIN_WORDS) | (
        100 * signals["n_repeat_words"] > MAX_REPEAT_PERCENT * signals["n_words"]
    )


def candidate_lines(docs: DataFrame, host: str) -> DataFrame:
    """(f_host, all_documents, candidates): per host, its distinct texts, and the
    hashes of lines in too many of them."""
    documents = docs.select(
        F.col(host).alias("f_host"),
        F.xxhash64("text").alias("document"),
        F.array_distinct(F.transform(F.filter(lines(F.col("text")), has_word), line_hash)).alias("hashes"),
    )
    found = documents.select("f_host", "document", F.explode("hashes").alias("line")).distinct()
    per_line = found.groupBy("f_host", "line").agg(F.count("*").alias("documents"))
    per_host = (
        documents.select("f_host", "document")
        .distinct()
        .groupBy(F.col("f_host").alias("t_host"))
        .agg(F.count("*").alias("all_documents"))
    )
    return (
        per_line.where(F.col("documents") >= MIN_LINE_DOCUMENTS)
        .join(per_host, F.col("f_host").eqNullSafe(F.col("t_host")))
        .where(above_limit("documents", "all_documents"))
        .groupBy("f_host")
        .agg(F.first("all_documents").alias("all_documents"), F.collect_set("line").alias("candidates"))
    )


def above_limit(documents: str, all_documents: str) -> Column:
    return (F.col(documents) >= MIN_LINE_DOCUMENTS) & (
        100 * F.col(documents) > MAX_LINE_PERCENT * F.col(all_documents)
    )


def without(text: Column, listed: Column) -> Column:
    """The lines of a text that are not listed by their hash.

    The list is met with all of the text's lines at once, by hashing, so that
    its length does not count for every line.
    """

    def kept(found: Column) -> Column:
        return F.filter(lines(text), lambda line: ~(has_word(line) & F.array_contains(found, line_hash(line))))

    own = F.transform(F.filter(lines(text), has_word), line_hash)
    return let(F.array_intersect(own, listed), lambda found: F.when(F.size(found) > 0, kept(found)).otherwise(lines(text)))


def listed_hashes(hosts: DataFrame, column: str) -> int:
    """How many hashes the lists of all hosts hold together."""
    return hosts.agg(F.coalesce(F.sum(F.size(column) + 1), F.lit(0))).first()[0]


def frequent_lines(spark: SparkSession, docs: DataFrame, host: str = "source") -> DataFrame:
    """Per host, the hashes of lines in too many of its distinct documents.

    A text that the candidates would deplete is taken for a near copy of the
    others that share its lines: together they are one document of each line.
    """
    candidates, _ = materialise(spark, candidate_lines(docs, host), "candidate-lines")
    text = F.col("text")
    texts = docs.select(F.col(host).alias("host"), "text").join(
        broadcast_if_small(candidates, listed_hashes(candidates, "candidates")), F.col("host").eqNullSafe(F.col("f_host"))
    )
    hashes = F.transform(F.filter(lines(text), has_word), line_hash)
    left = F.size(words(F.array_join(without(text, F.col("candidates")), "\n")))
    found = (
        texts.select(
            "f_host",
            "all_documents",
            F.array_intersect(hashes, "candidates").alias("hashes"),
            F.when(100 * left >= MIN_LEFT_PERCENT * F.size(words(text)), F.xxhash64("text")).alias("document"),
        )
        .select("f_host", "all_documents", "document", F.explode("hashes").alias("line"))
        .distinct()
    )
    return (
        found.groupBy("f_host", "line")
        .agg(F.first("all_documents").alias("all_documents"), F.count("*").alias("documents"))
        .where(above_limit("documents", "all_documents"))
        .groupBy("f_host")
        .agg(F.collect_set("line").alias("frequent"))
    )


def judged(spark: SparkSession, docs: DataFrame, host: str = "source") -> DataFrame:
    """Each row under `kept_row`, with signals, the text that is left and the verdict."""
    frequent, _ = materialise(spark, frequent_lines(spark, docs, host), "frequent-lines")
    text = F.col("kept_row.text")
    listed = F.coalesce(F.col("frequent"), F.array().cast("array<bigint>"))
    clean = F.when(F.size(listed) > 0, F.array_join(without(text, listed), "\n")).otherwise(text)
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("kept_row"),
        F.col(host).alias("host"),
    ).join(
        broadcast_if_small(frequent, listed_hashes(frequent, "frequent")),
        F.col("host").eqNullSafe(F.col("f_host")),
        "left",
    )
    rows = rows.select("kept_row", base_signals(text).alias("signals"), F.when(text.isNotNull(), clean).alias("clean_text"))
    left = F.when(F.col("clean_text").eqNullSafe(text), F.col("signals.n_words")).otherwise(
        F.size(words(F.col("clean_text"))).cast("long")
    )
    rows = rows.select("*", left.alias("words_left"), base_failed(F.col("signals")).alias("base_failed"))
    depleted = 100 * F.col("words_left") < MIN_LEFT_PERCENT * F.col("signals.n_words")
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_report(spark: SparkSession, docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row: doc_id, the signals, base_failed, words left by line removal, kept."""
    return judged(spark, docs, host).select(
        F.col("kept_row.doc_id").alias("doc_id"), "signals.*", "base_failed", "words_left", "kept"
    )


def quality_documents(spark: SparkSession, docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that pass, without the lines above the limit; columns kept.

    The number of a row, which no filter is moved below, keeps the filter above
    the projections: merged with them, it would compute the signals of a text
    once for each use.
    """
    rows = judged(spark, docs, host).select("kept_row", "clean_text", "kept")
    numbered = rows.withColumn("row_number", F.monotonically_increasing_id())
    fields = [
        F.col("clean_text").alias(name) if name == "text" else F.col(f"kept_row.`{name}`")
        for name in docs.columns
    ]
    return numbered.where("kept AND row_number >= 0").select(*fields)
