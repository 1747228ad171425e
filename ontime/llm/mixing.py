"""Mixing sources to target weights by nested hash thresholds.

A mix takes every document of a source `repeats` times and, once more, those
whose hash lies below a threshold. The threshold comes from histograms of
words by source and hash bucket: find the bucket in which the budget runs out,
split that bucket alone into finer ones, and go on until it is one hash value.
Nothing is sorted, the selection for a smaller budget is part of that for a
larger one, and a rerun gives the same rows.

Defined results: null text has size 0; documents of size 0 are taken with 0
words; null is a source of its own, last in order; equal rows have equal
hashes and are taken or left together; an empty table gives an empty result;
other columns are left alone. Of the hash value at the threshold all rows are
taken if that brings the source nearer to its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime.llm.common import broadcast_if_small, hash60, materialise, words

# Four rounds of 15 bits use up the 60 bits of the hash.
BUCKET_BITS = 15
ROUNDS = 4


def sized(docs: DataFrame, source: str = "source") -> DataFrame:
    """Per row: key, source, size in words and hash. The only pass over the texts."""
    return docs.select(
        F.col("doc_id"),
        F.col(source).alias("source"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        hash60(F.col("doc_id"), F.col("text")).alias("hash"),
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3
) -> DataFrame:
    """Per source: its size and its target, limited to `max_repeats` sizes.

    The excess of limited sources goes to the others by weight, until none is
    above its limit. With sources in order of limit by weight, the level that
    remains per unit of weight rises up to the first source below its limit
    and falls after it, so its maximum is the final level.

    The windows have no partition: one task orders one row per source, so the
    number of sources, not of documents, has to fit a task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*(F.lit(w).cast("long") for w in weights)), position % len(weights) + 1
    )
    scale = 1
    for w in weights:
        scale *= w
    limits = totals.select(
        "source",
        "source_size",
        position.alias("position"),
        weight.alias("weight"),
        (F.col("source_size") * max_repeats).alias("limit"),
    )
    by_limit = Window.orderBy(
        F.expr(f"`limit` * ({scale} div weight)"), "position"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("position").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(everything) - F.sum("limit").over(by_limit) + F.col("limit")
    weight_left = F.sum("weight").over(everything) - F.sum("weight").over(by_limit) + F.col("weight")
    levels = limits.withColumn("level", left.cast("double") / weight_left.cast("double"))
    level = F.max("level").over(everything)
    target = F.least(F.col("limit").cast("double"), level * F.col("weight").cast("double"))
    return levels.select("source", "source_size", "position", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame, max_repeats: int = 3) -> DataFrame:
    """Per source: whole repeats, and the hash up to which documents go once more."""
    whole = F.when(
        F.col("source_size") > 0,
        F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size"))),
    ).otherwise(0)
    plan = targets.withColumn("repeats", whole.cast("long")).withColumn(
        "budget", F.col("target") - (F.col("repeats") * F.col("source_size")).cast("double")
    )
    rest = plan.where((F.col("budget") > 0) & (F.col("repeats") < max_repeats)).select(
        F.col("source").alias("b_source"),
        "budget",
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("before"),
    )
    for step in range(1, ROUNDS + 1):
        above = F.shiftright("hash", BUCKET_BITS * (ROUNDS - step + 1))
        bucket = F.shiftright("hash", BUCKET_BITS * (ROUNDS - step))
        histogram = (
            sizes.select("source", "hash", "size")
            .join(rest, F.col("source").eqNullSafe(F.col("b_source")) & (above == F.col("prefix")))
            .groupBy("b_source", "budget", "before", bucket.alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        running = F.sum("words").over(Window.partitionBy("b_source").orderBy("bucket"))
        upto = F.col("before") + F.col("running")
        rest = (
            histogram.withColumn("running", running)
            .where((upto >= F.col("budget")) & (upto - F.col("words") < F.col("budget")))
            .select(
                "b_source",
                "budget",
                F.col("bucket").alias("prefix"),
                (upto - F.col("words")).alias("before"),
                "words",
            )
        )
    nearer = F.col("before") + F.col("words") - F.col("budget") <= F.col("budget") - F.col("before")
    ends = rest.select(
        "b_source", F.when(nearer, F.col("prefix") + 1).otherwise(F.col("prefix")).alias("below")
    )
    return plan.join(ends, F.col("source").eqNullSafe(F.col("b_source")), "left").select(
        F.col("source").alias("p_source"),
        "source_size",
        "target",
        "repeats",
        F.coalesce("below", F.lit(0).cast("long")).alias("below"),
    )


def copies() -> Column:
    """How often a row is taken, from its hash and its source's plan."""
    return F.col("repeats") + (F.col("hash") < F.col("below")).cast("long")


def mix_plan(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_repeats: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """The sized rows and the plan of each source, both stored in the shared folder."""
    sizes, _ = materialise(spark, sized(docs), "mix-sizes")
    plan = thresholds(sizes, source_targets(sizes, weights, max_repeats), max_repeats)
    plan, _ = materialise(spark, plan, "mix-plan")
    return sizes, broadcast_if_small(plan, plan.count())


def mix(spark: SparkSession, docs: DataFrame, **choices) -> DataFrame:
    """Per document: its size, its source's size and target, and the words taken."""
    sizes, plan = mix_plan(spark, docs, **choices)
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies()).alias("taken"),
    )


def mixed_documents(spark: SparkSession, docs: DataFrame, **choices) -> DataFrame:
    """The mix itself: each document as many times as it is taken, columns kept."""
    _, plan = mix_plan(spark, docs, **choices)
    kept = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("kept")
    rows = docs.select(kept, F.col("source"), hash60(F.col("doc_id"), F.col("text")).alias("hash"))
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
        .select("kept", F.explode(F.array_repeat(F.lit(0), copies().cast("int"))))
        .select("kept.*")
    )
