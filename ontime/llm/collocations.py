"""Phrases of two and three words that belong together, by best-first growth.

A phrase scores scale * a * a / (l * r), floored: a counts the phrase, l and r
its two parts, and the cut with the least score decides. Of a phrase that
begins with the words v w, the cut behind v bounds the score: the rest occurs
at least as often as the phrase, and the phrase at most as often as v w, so
that no growth of v w scores above scale * f(v w) / f(v). All pairs of words
are the growths of single words, whose bound is the whole scale; pairs are
grown best first. In each round a language has a threshold, and every pair
whose bound reaches it is grown. Then all phrases that score the threshold or
more are known, and so is all that can supplant them: a pair that reaches the
threshold has a bound that does, so its growths are counted, and phrases that
end with it are counted with them. Once as many phrases survive as are wanted,
the language is settled, ties included; otherwise its threshold falls to where
four times as many pairs score, and what was not counted yet is. At threshold
zero everything has been.

Texts become blocks of a bounded number of words of one language: numbers into
the block's own word list, with marks where a piece ends. Spark counts words
over the lists, and gives each block the numbers of its frequent words and,
in a round, the pairs to grow of which it has both words. A block gives its
distinct pairs or triples with counts, and Spark adds those up. Nothing is
broadcast by hint, and of the corpus only the number of unsettled languages
reaches the driver. A pair beyond any number of blocks costs a row per block.

Defined results: null texts and texts without words add nothing; a null
language is `und`; each row counts, whatever its other columns; ties end in
the order of the phrase's bytes; an empty table gives an empty result; a text
of any length is counted whole, and cut into blocks between pieces only.
Counts are exact up to 10**14.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime.llm.common import drop_folders, materialise

MIN_COUNT = 10
KEPT = 2000
SCALE = 1_000_000
# A phrase is supplanted by a longer one with at least this share of its count.
SUPPLANT_PERCENT = 50
UNKNOWN = "und"

# Words that a task holds before it closes its blocks, some 30 bytes each, and
# characters that it splits at once.
BLOCK_WORDS = 4_000_000
SLICE_CHARS = 1_000_000
# Pairs of words by which the first threshold is chosen, per phrase wanted,
# and by how much more each further round takes.
FIRST_PAIRS = 2
MORE_PAIRS = 4
# The last cut of phrases of one language is made in so many parts first.
CUT_PARTS = 64
# Rows that a task hands to Spark at once.
BATCH_ROWS = 200_000

# Fixed values of the contract: pieces end at these, words at a space or tab.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SEPARATORS = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")
PIECE_END, NOTHING = 0, 1

CODED = "block long, lang string, words array<string>, counts array<long>, ids binary"
NUMBERED = "block long, lang string, globals array<long>, ids binary"
PAIRS = "w1 long, w2 long, n long"
TRIPLES = "w0 long, w1 long, w2 long, n long"


class WordList(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def packed(ids: np.ndarray) -> bytes:
    """Numbers as compressed little-endian 32-bit integers, their count first."""
    raw = ids.astype("<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], size, asbytes=True), "<i4")


def slices(text: bytes) -> Iterator[bytes]:
    """A text without capitals in parts that end where a piece does."""
    text = text.lower().translate(SEPARATORS)
    start = 0
    while start < len(text):
        end = text.find(b"\n", start + SLICE_CHARS)
        end = len(text) if end < 0 else end + 1
        yield text[start:end]
        start = end


class Block:
    """The words of one language that a task holds."""

    def __init__(self):
        self.words = WordList({b"\n": PIECE_END, b"": NOTHING})
        self.ids: list[np.ndarray] = []

    def add(self, text: bytes) -> int:
        """Number a part of a text; a piece ends at either end of it."""
        words = (text.replace(b"\n", b" \n ") + b" \n").split(b" ")
        ids = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        self.ids.append(ids[ids != NOTHING])
        return len(self.ids[-1])

    def row(self) -> dict:
        ids = np.concatenate(self.ids)
        counts = np.bincount(ids, minlength=len(self.words))
        words = [word.decode() for word in self.words]
        return {"words": words[2:], "counts": counts[2:], "ids": packed(ids)}


def coded_blocks(documents: DataFrame, text: str, lang: str) -> DataFrame:
    """The texts as numbers, in blocks of one language and task."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        blocks: dict[str, Block] = {}
        size = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for name, one in zip(batch.column(0).to_pylist(), texts, strict=True):
                for part in slices(one.as_py()):
                    size += blocks.setdefault(name, Block()).add(part)
                    if size >= BLOCK_WORDS:
                        yield from closed(blocks, number)
                        number, blocks, size = number + len(blocks), {}, 0
        yield from closed(blocks, number)

    whole = documents.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    return whole.mapInArrow(code, CODED)


def closed(blocks: dict[str, Block], number: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("lang", pa.string()),
            ("words", pa.list_(pa.string())),
            ("counts", pa.list_(pa.int64())),
            ("ids", pa.binary()),
        ]
    )
    for at, (lang, block) in enumerate(blocks.items()):
        yield pa.RecordBatch.from_pylist([{"block": number + at, "lang": lang, **block.row()}], schema)


def listed_words(coded: DataFrame) -> DataFrame:
    """(block, lang, place, word, n) for each word of each block's list."""
    return coded.select(
        "block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "one")
    ).select("block", "lang", "place", F.col("one.words").alias("word"), F.col("one.counts").alias("n"))


def number_block(coded: pa.Table, places: pa.Table) -> pa.Table:
    """A block in numbers of its frequent words only, in order of their global
    numbers; marks (-1) stand for ends of pieces and for other words."""
    place, number = (places.column(c).to_numpy() for c in ("place", "id"))
    order = np.argsort(number)
    ids = unpacked(coded.column("ids")[0].as_py())
    to = np.full(max(int(ids.max(initial=0)), int(place.max(initial=0)) + 2) + 1, -1, np.int32)
    to[place[order] + 2] = np.arange(len(order))
    ids = to[ids]
    needless = np.append(False, (ids[1:] < 0) & (ids[:-1] < 0))[: len(ids)]
    return pa.table(
        {
            "block": coded.column("block"),
            "lang": coded.column("lang"),
            "globals": pa.array([number[order]], pa.list_(pa.int64())),
            "ids": pa.array([packed(ids[~needless])], pa.binary()),
        }
    )


def numbered_blocks(coded: DataFrame, vocabulary: DataFrame) -> DataFrame:
    words = listed_words(coded).select("block", "place", "lang", "word")
    places = words.join(vocabulary, ["lang", "word"]).select(F.col("block").alias("to"), "place", "id")
    # Blocks without a frequent word have no pairs either.
    return (
        coded.select("block", "lang", "ids")
        .join(places.select(F.col("to").alias("block")).distinct(), "block", "left_semi")
        .groupBy("block")
        .cogroup(places.groupBy("to"))
        .applyInArrow(number_block, NUMBERED)
    )


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of neighbours of each block, with counts."""
    for batch in batches:
        for known, data in zip(batch.column("globals"), batch.column("ids"), strict=True):
            known = known.values.to_numpy()
            codes, valid = pair_codes(unpacked(data.as_py()), len(known))
            distinct, n = np.unique(codes[valid], return_counts=True)
            for at in range(0, len(distinct), BATCH_ROWS):
                some = distinct[at : at + BATCH_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (known[some // len(known)], known[some % len(known)], n[at : at + BATCH_ROWS])],
                    names=["w1", "w2", "n"],
                )


def pair_codes(ids: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """One number for each two neighbours, and where both are words."""
    left, right = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
    return left * words + right, (left >= 0) & (right >= 0)


def grow_block(numbered: pa.Table, frontier: pa.Table) -> pa.Table:
    """Distinct triples of a block that begin with a pair to grow or end with one
    that may survive, but were not counted in an earlier round; with counts."""
    known = numbered.column("globals").combine_chunks().values.to_numpy()
    ids = unpacked(numbered.column("ids")[0].as_py())
    codes, valid = pair_codes(ids, len(known))
    left, right = (np.searchsorted(known, frontier.column(c).to_numpy()) for c in ("w1", "w2"))
    wanted = left * len(known) + right
    order = np.argsort(wanted)
    wanted = wanted[order]
    place = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
    met = valid & (wanted[place] == codes)
    grown, linked, was_grown, was_linked = (
        met & frontier.column(c).to_numpy().astype(bool)[order][place]
        for c in ("grown", "linked", "was_grown", "was_linked")
    )
    chosen = (grown[:-1] | linked[1:]) & ~(was_grown[:-1] | was_linked[1:]) & valid[:-1] & valid[1:]
    at = np.flatnonzero(chosen)
    pairs, which = np.unique(codes[at], return_inverse=True)
    triples, n = np.unique(which.astype(np.int64) * len(known) + ids[at + 2], return_counts=True)
    first = pairs[triples // len(known)]
    return pa.table(
        {
            "w0": known[first // len(known)],
            "w1": known[first % len(known)],
            "w2": known[triples % len(known)],
            "n": pa.array(n, pa.int64()),
        }
    )


def grown_triples(numbered: DataFrame, frontier: DataFrame, min_count: int) -> DataFrame:
    """Frequent triples that the frontier's pairs give, over all blocks."""
    members = numbered.select(F.col("block").alias("to"), F.explode("globals").alias("id"))
    needed = (
        frontier.join(members, frontier.w1 == members.id)
        .drop("id")
        .join(members.select("to", F.col("id").alias("w2")), ["to", "w2"])
    )
    cut = numbered.join(needed.select(F.col("to").alias("block")).distinct(), "block", "left_semi")
    counted = cut.groupBy("block").cogroup(needed.groupBy("to")).applyInArrow(grow_block, TRIPLES)
    return counted.groupBy("w0", "w1", "w2").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)


def score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)); never above SCALE."""
    f = {name: f"CAST({name} AS DECIMAL(14,0))" for name in (a, left, right)}
    return F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * {f[a]} * {f[a]} div ({f[left]} * {f[right]})")


def scored_pairs(counted: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Frequent pairs with their words, counts, score, and bound of their growths."""
    first = vocabulary.select(
        F.col("id").alias("w1"), "lang", F.col("word").alias("t1"), F.col("f").alias("f1")
    )
    second = vocabulary.select(
        F.col("id").alias("w2"), F.col("word").alias("t2"), F.col("f").alias("f2")
    )
    return (
        counted.join(first, "w1")
        .join(second, "w2")
        .withColumn("score", score("a", "f1", "f2"))
        .withColumn("bound", F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(14,0)) div f1"))
    )


def scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples with their words and the cut of the least score, the first of equals."""
    head = pairs.select(
        F.col("w1").alias("w0"),
        F.col("w2").alias("w1"),
        "lang",
        F.concat_ws(" ", "t1", "t2").alias("start"),
        F.col("f1").alias("f0"),
        F.col("a").alias("a01"),
    )
    tail = pairs.select("w1", "w2", "t2", "f2", F.col("a").alias("a12"))
    early = F.col("early") <= F.col("late")
    return (
        triples.join(head, ["w0", "w1"])
        .join(tail, ["w1", "w2"])
        .withColumn("early", score("a", "f0", "a12"))
        .withColumn("late", score("a", "a01", "f2"))
        .select(
            "lang",
            F.concat_ws(" ", "start", "t2").alias("phrase"),
            "a",
            F.when(early, F.col("f0")).otherwise(F.col("a01")).alias("l"),
            F.when(early, F.col("a12")).otherwise(F.col("f2")).alias("r"),
            F.least("early", "late").alias("score"),
        )
    )


def thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """Per language a score that at least `wanted` of its pairs reach; zero if it has fewer.

    From a histogram of a few hundred rows per language.
    """
    step = F.floor(F.log2(F.col("score") + 1) * 16)
    histogram = pairs.groupBy("lang", step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("least")
    )
    down = Window.partitionBy("lang").orderBy(F.col("step").desc())
    reached = histogram.withColumn("upto", F.sum("n").over(down))
    enough = F.when(F.col("upto") >= wanted, F.col("least"))
    return reached.groupBy("lang").agg(F.coalesce(F.max(enough), F.lit(0).cast("long")).alias("least"))


def survivors(pairs: DataFrame, triples: DataFrame, limits: DataFrame, percent: int) -> DataFrame:
    """Phrases of the languages in `limits` that reach the threshold and are not supplanted."""
    of_pair = [
        triples.select(F.col(x).alias("w1"), F.col(y).alias("w2"), F.col("a").alias("longer"))
        for x, y in (("w0", "w1"), ("w1", "w2"))
    ]
    longest = of_pair[0].unionByName(of_pair[1]).groupBy("w1", "w2").agg(F.max("longer").alias("longer"))
    supplanted = F.coalesce(F.col("longer") * 100 >= F.col("a") * percent, F.lit(False))
    good = (
        pairs.join(limits, "lang")
        .where(F.col("score") >= F.col("least"))
        .join(longest, ["w1", "w2"], "left")
        .where(~supplanted)
    )
    fields = ["lang", "phrase", "a", "l", "r", "score"]
    two = good.select(
        "lang",
        F.concat_ws(" ", "t1", "t2").alias("phrase"),
        "a",
        F.col("f1").alias("l"),
        F.col("f2").alias("r"),
        "score",
    )
    three = scored_triples(triples, pairs).join(limits, "lang").where(F.col("score") >= F.col("least"))
    return two.unionByName(three.select(*fields))


def first_of_each(phrases: DataFrame, kept: int) -> DataFrame:
    """The first phrases of each language with their ranks; parts of a language are cut before."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = Window.partitionBy("lang", "part").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    return (
        phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(CUT_PARTS)))
        .withColumn("rank", F.row_number().over(part))
        .where(F.col("rank") <= kept)
        .withColumn("rank", F.row_number().over(whole).cast("long"))
        .where(F.col("rank") <= kept)
        .drop("part")
    )


def collocations(
    spark: SparkSession,
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    kept: int = KEPT,
    supplant_percent: int = SUPPLANT_PERCENT,
    first_pairs: int = FIRST_PAIRS,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    `first_pairs` times `kept` pairs reach the first round's threshold; the
    result does not depend on it.
    """
    coded, coded_folder = materialise(spark, coded_blocks(documents, text, lang), "coded")
    totals = coded.groupBy("lang").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)).alias("n")
    )
    totals, _ = materialise(spark, totals, "word-totals")
    frequent = (
        listed_words(coded).groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    )
    vocabulary, _ = materialise(
        spark, frequent.withColumn("id", F.monotonically_increasing_id()), "vocabulary"
    )
    numbered, _ = materialise(spark, numbered_blocks(coded, vocabulary.drop("f")), "numbered")
    drop_folders(spark, [coded_folder])
    counted = (
        numbered.select("globals", "ids")
        .mapInArrow(count_pairs, PAIRS)
        .groupBy("w1", "w2")
        .agg(F.sum("n").alias("a"))
        .where(F.col("a") >= min_count)
    )
    pairs, _ = materialise(spark, scored_pairs(counted, vocabulary), "pairs")

    limits, triples, settled = None, None, []
    wanted = first_pairs * kept
    while True:
        now = thresholds(pairs, wanted)
        if limits is not None:
            now = now.join(limits.select("lang", F.col("least").alias("before")), "lang")
        else:
            now = now.withColumn("before", F.lit(SCALE + 1).cast("long"))
        now, _ = materialise(spark, now, "thresholds")
        frontier = pairs.join(now, "lang").where(F.col("bound") >= F.col("least")).select(
            "w1",
            "w2",
            (F.col("bound") >= F.col("least")).alias("grown"),
            (F.col("score") >= F.col("least")).alias("linked"),
            (F.col("bound") >= F.col("before")).alias("was_grown"),
            (F.col("score") >= F.col("before")).alias("was_linked"),
        )
        fresh, _ = materialise(spark, grown_triples(numbered, frontier, min_count), "triples")
        triples = fresh if triples is None else triples.unionByName(fresh)
        found, _ = materialise(
            spark, survivors(pairs, triples, now.select("lang", "least"), supplant_percent), "phrases"
        )
        reached = found.groupBy("lang").agg(F.count(F.lit(1)).alias("reached"))
        enough = (F.coalesce("reached", F.lit(0)) >= kept) | (F.col("least") == 0)
        judged, _ = materialise(
            spark, now.join(reached, "lang", "left").select("lang", "least", enough.alias("done")), "settled"
        )
        settled.append(found.join(judged.where("done").select("lang"), "lang", "left_semi"))
        limits = judged.where(~F.col("done"))
        if limits.isEmpty():
            break
        wanted *= MORE_PAIRS
    phrases = settled[0]
    for more in settled[1:]:
        phrases = phrases.unionByName(more)
    return first_of_each(phrases, kept).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
