"""Exact duplicates by a tree merge of sorted runs of text digests.

Each task sorts the digests of its texts into a run with one row per digest:
the row that stays, and how many there are. Runs are then exchanged in rounds.
Partitions are numbered in digits of base `fanout`; in round r the partitions
that differ in digit r only exchange their runs, each keeping the digests whose
own digit r is its number's. What arrives is merged in order of digest (Spark's
external sort merges the pieces, on disk where need be) and folded to one row
per digest again. After the last round a partition holds one range of digests,
whole. A text that a third of all rows share costs a row per partition in the
first round and ever fewer after it; no round brings it together at once.

Two texts are taken as equal if SHA-256, length in bytes and a second, 64-bit
hash agree; all three travel with a run and are compared at every level.

Every row then gets its class by a join on the digest. Classes beyond a limit
are broadcast: there are at most `HOT_CLASSES` of them, since each has more
than that share of all rows. Others are joined in a shuffle.

Defined results: a null text counts as the empty one; a null key counts as
less than any other, and of rows with one key and text one stays; an empty
table gives an empty result; texts are hashed whole; columns other than the
key and the text do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Literal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import materialise

# Partitions that exchange runs in one round.
FANOUT = 8
# Digests that a partition should hold after the last round, at most; and the
# least number of rounds.
RANGE_ROWS = 1_000_000
LEAST_ROUNDS = 2
# At most so many classes are broadcast, some 80 bytes each.
HOT_CLASSES = 50_000
LEAST_HOT = 1_000

IDENTITY = ["digest", "n_bytes", "check"]

def _same_as_before(columns: list[pa.Array]) -> np.ndarray:
    """For each row but the first, whether it equals the one before it."""
    same = np.ones(len(columns[0]) - 1, bool)
    for column in columns:
        same &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return same


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal digests in a sorted run the first row, with their sizes summed up.

    A task holds one batch and the last digest of the one before.
    """
    kept: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if kept is not None:
            batch = pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
        identity = [batch.column(batch.schema.get_field_index(name)) for name in IDENTITY]
        starts = np.flatnonzero(np.append(True, ~_same_as_before(identity)))
        place = batch.schema.get_field_index("size")
        sizes = np.add.reduceat(batch.column(place).to_numpy(), starts)
        folded = batch.take(pa.array(starts)).set_column(place, "size", pa.array(sizes, pa.int64()))
        if folded.num_rows > 1:
            yield folded.slice(0, folded.num_rows - 1)
        kept = folded.slice(folded.num_rows - 1)
    if kept is not None:
        yield kept


def rounds_for(rows: int, fanout: int, range_rows: int) -> int:
    """Rounds after which a partition holds some `range_rows` digests at most."""
    rounds = LEAST_ROUNDS
    while fanout**rounds * range_rows < rows:
        rounds += 1
    return rounds


def sorted_run(rows: DataFrame, keep: Literal["largest", "smallest"]) -> DataFrame:
    """What each partition holds, as a run: in order of digest, one row for each."""
    best = F.col("keep_id").desc_nulls_last() if keep == "largest" else F.col("keep_id").asc_nulls_last()
    return rows.sortWithinPartitions(*IDENTITY, best, "keep_row").mapInArrow(fold, rows.schema)


def merged_runs(
    leaves: DataFrame, rounds: int, fanout: int, keep: Literal["largest", "smallest"]
) -> DataFrame:
    """One row per digest: runs of the given partitions, exchanged and merged in rounds."""
    partitions = fanout**rounds
    here = F.pmod(F.spark_partition_id(), F.lit(partitions)).cast("long")
    runs = sorted_run(leaves.withColumn("at", here), keep)
    for number in range(rounds):
        digit = fanout**number
        own, wanted = (F.floor(F.col(c) / digit) % fanout for c in ("at", "head"))
        sent = runs.withColumn("at", F.col("at") + (wanted - own) * digit)
        runs = sorted_run(sent.repartitionById(partitions, F.col("at").cast("int")), keep)
    return runs


def text_leaves(
    documents: DataFrame,
    key: str,
    text: str,
    normalise: Callable[[Column], Column] | None,
    number: Column,
) -> DataFrame:
    """A row per document: its digests, its key and its number. The digest's
    head, 52 bits of it, tells where the digest goes."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    if normalise is not None:
        whole = normalise(whole)
    hexed = F.sha2(whole, 256)
    return documents.select(
        F.conv(F.substring(hexed, 1, 13), 16, 10).cast("long").alias("head"),
        F.unhex(hexed).alias("digest"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        F.xxhash64(whole).alias("check"),
        F.col(f"`{key}`").cast("long").alias("keep_id"),
        number.alias("keep_row"),
        F.lit(1).cast("long").alias("size"),
    )


def judged(
    spark: SparkSession,
    leaves: DataFrame,
    keep: Literal["largest", "smallest"] = "largest",
    fanout: int = FANOUT,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Per leaf its number, its key, its digest and its class."""
    written, _ = materialise(spark, leaves, "digests")
    rows = written.count()
    rounds = rounds_for(rows, fanout, range_rows)
    classes, _ = materialise(spark, merged_runs(written, rounds, fanout, keep), "digest-classes")
    limit = max(LEAST_HOT, rows // HOT_CLASSES)
    several = classes.where("size > 1").select(
        *[F.col(c).alias(f"c_{c}") for c in (*IDENTITY, "keep_id", "keep_row", "size")]
    )
    hot = F.broadcast(several.where(F.col("c_size") > limit))
    same = [F.col(c) == F.col(f"c_{c}") for c in IDENTITY]
    rest = written.join(hot, same, "left_anti").join(several.where(F.col("c_size") <= limit), same, "left")
    alone = F.col("c_size").isNull()
    return (
        written.join(hot, same)
        .unionByName(rest)
        .select(
            F.col("keep_row").alias("row"),
            F.col("keep_id").alias("key"),
            F.when(alone, F.col("keep_id")).otherwise(F.col("c_keep_id")).alias("keep_id"),
            F.coalesce("c_size", F.lit(1).cast("long")).alias("group_size"),
            (alone | F.coalesce(F.col("keep_row") == F.col("c_keep_row"), F.lit(False))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def exact_duplicates(
    spark: SparkSession,
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    **options,
) -> DataFrame:
    """Per document: key, keep_id (key of the row that stays), group_size, kept, text_sha256.

    `normalise` changes texts before they are compared; by default nothing
    does. Of equal texts the row with the largest key stays, or the smallest
    with `keep="smallest"`. Other options are those of `judged`.
    """
    leaves = text_leaves(documents, key, text, normalise, F.monotonically_increasing_id())
    return judged(spark, leaves, **options).drop("row").withColumnRenamed("key", key)


def without_copies(
    spark: SparkSession,
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    **options,
) -> DataFrame:
    """The documents that stay, with all their columns. Options as above."""
    number = "_row"
    while number in documents.columns:
        number += "_"
    numbered, _ = materialise(
        spark, documents.withColumn(number, F.monotonically_increasing_id()), "numbered"
    )
    leaves = text_leaves(numbered, key, text, normalise, F.col(number))
    dropped = judged(spark, leaves, **options).where(~F.col("kept")).select(F.col("row").alias(number))
    return numbered.join(dropped, number, "left_anti").drop(number)
