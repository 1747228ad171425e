"""Exact top-k search by inner product with norm-bucketed retrieval.

All vectors are ordered by length and cut into blocks, and blocks into buckets.
For a query and a bucket, the query's k-th best score so far, divided by its
own length and the bucket's, is the least cosine that a vector of the bucket
needs. Above 1 the bucket is skipped; where it is high, the range that it
leaves for the query's largest coordinates sorts vectors out; otherwise all
those long enough are multiplied. Every product is verified in full, so
pruning never changes a result.

A first round over the block of the longest vectors gives each query a score
to start with, and with it the least length that a vector needs. Queries are
ordered by that and cut into blocks too. A block of vectors is sent to the
blocks of queries that its longest one may be of use to, and to no others. A
task holds one block of each, and sends back k rows per query.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part; vectors of different dimension do not meet; equal
rows each take a place; ties go to the smaller id, null last; a row with the
query's id is its own; fewer candidates than k give all of them; an empty
table gives an empty result; other columns do not matter. Products are
computed in float64 where they are sure to be exact, else in Python integers;
a score beyond 64 bits ends the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime.llm.common import broadcast_if_small, materialise
from ontime.operators.ranking import rank_all

BLOCK_ROWS = 4096
QUERY_BLOCK_ROWS = 1024
BUCKET_ROWS = 256
# From this cosine on, coordinates are worth looking at first.
COORDINATE_COSINE = 0.95
FOCUS_COORDINATES = 4
EXACT = 2.0**53
# The longest vectors, which give each query a score to start with.
START_ROWS = 1024
LAST_ID = 2**63 - 1
# Room for rounding: what may reach a threshold must not be left out.
ROUNDING = 1e-12
NARROW = 1e-9

FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 64, column: str = "embedding") -> DataFrame:
    """vec_id, whole-number components as doubles, length and dimension; bad rows left out."""

    def whole_number(x: Column) -> Column:
        # From 2^53 on every double is whole, and `floor` would end at 2^63.
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    whole = F.transform(column, whole_number)
    bad = F.exists(
        column,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    usable = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & ~bad)
    squares = F.aggregate(F.col("vector"), F.lit(0.0), lambda total, x: total + x * x)
    return usable.select("vec_id", whole.alias("vector")).select(
        "vec_id", "vector", F.sqrt(squares).alias("length"), F.size("vector").alias("dimension")
    )


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products: in float64 if no sum can leave its whole numbers."""
    bound = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * queries.shape[1]
    if bound < EXACT:
        return queries @ candidates.T
    as_int = np.vectorize(int, otypes=[object])
    return as_int(queries) @ as_int(candidates).T


def best(scores: np.ndarray, ties: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, those with smaller `ties` first."""
    places = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    return places[np.lexsort((ties[places], -scores[places]))][:k]


class Block:
    """One block of candidates, longest first, searched query by query."""

    def __init__(self, candidates: pd.DataFrame, k: int):
        lengths = candidates["length"].to_numpy()
        order = np.argsort(-lengths, kind="stable")
        self.k = k
        self.ids = candidates["vec_id"].to_numpy()[order]
        self.known = candidates["known"].to_numpy()[order]
        self.lengths = lengths[order]
        self.vectors = np.stack(candidates["vector"].to_numpy())[order]

    def search(
        self, ids: np.ndarray, queries: np.ndarray, start: np.ndarray
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Positions and scores of the best for each query.

        `start` has a score for each query that k candidates are known to reach.
        """
        sizes = np.sqrt((queries * queries).sum(axis=1))
        threshold = start.copy()
        best_of = [(np.empty(0, np.int64), np.empty(0)) for _ in ids]
        for first in range(0, len(self.ids), BUCKET_ROWS):
            rows = np.arange(first, min(first + BUCKET_ROWS, len(self.ids)))
            longest = sizes * self.lengths[first]
            active = (threshold <= 0) | (longest * (1 + ROUNDING) >= threshold)
            if not active.any():
                break
            with np.errstate(divide="ignore", invalid="ignore"):
                cosine = np.where(threshold > 0, threshold / longest * (1 - ROUNDING), -1.0)
            by_coordinates = active & (cosine >= COORDINATE_COSINE)
            for n in np.flatnonzero(by_coordinates):
                near = rows[self.in_range(queries[n] / sizes[n], cosine[n], rows)]
                if len(near):
                    scores = products(queries[n : n + 1], self.vectors[near])[0]
                    self.keep(n, ids[n], near, scores, threshold, best_of)
            by_length = np.flatnonzero(active & ~by_coordinates)
            if len(by_length):
                # Rows come longest first: those that any of these queries needs.
                need = np.where(threshold > 0, threshold / np.maximum(sizes, 1e-300), 0.0)
                least = need[by_length].min() * (1 - ROUNDING)
                enough = rows[self.lengths[rows] >= least]
                scores = products(queries[by_length], self.vectors[enough])
                hits = (scores >= threshold[by_length, None]).any(axis=1)
                for at in np.flatnonzero(hits):
                    self.keep(by_length[at], ids[by_length[at]], enough, scores[at], threshold, best_of)
        return best_of

    def keep(self, n, query_id, rows, scores, threshold, best_of) -> None:
        """Take rows that reach a query's threshold among its best, and raise the threshold."""
        good = scores >= threshold[n]
        good &= (self.ids[rows] != query_id) | ~self.known[rows]
        if not good.any():
            return
        found = np.concatenate([best_of[n][0], rows[good]])
        values = np.concatenate([best_of[n][1], scores[good]])
        kept = best(values, self.ids[found], self.k)
        best_of[n] = (found[kept], values[kept])
        if len(kept) == self.k:
            threshold[n] = max(threshold[n], float(values[kept[-1]]))

    def in_range(self, unit: np.ndarray, cosine: float, rows: np.ndarray) -> np.ndarray:
        """Rows whose coordinates, where the query's are largest, are within reach.

        A vector within the angle of the least cosine has each coordinate's
        own angle to the axis within as much of the query's.
        """
        focus = np.argsort(-np.abs(unit))[:FOCUS_COORDINATES]
        angle = np.arccos(np.clip(unit[focus], -1, 1))
        reach = np.arccos(min(cosine, 1.0))
        low = np.cos(np.minimum(angle + reach, np.pi)) - NARROW
        high = np.cos(np.maximum(angle - reach, 0)) + NARROW
        units = self.vectors[rows][:, focus] / self.lengths[rows, None]
        return ((units >= low) & (units <= high)).all(axis=1)


def exact_top_k(
    spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 20
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows of each query.

    Both tables come from `quantised`. Of several rows with one query id the
    least vector is searched for.
    """
    asked = queries.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(
        F.min(F.struct("vector", "length", "dimension")).alias("least")
    )
    asked = asked.select("vec_id", "least.*")
    # Null ids, which pandas would turn into floats, come last among ties.
    vectors = vectors.withColumn("known", F.col("vec_id").isNotNull()).withColumn(
        "vec_id", F.coalesce("vec_id", F.lit(LAST_ID))
    )
    # Both tables are written in order of what prunes them.
    stored = in_blocks(vectors, "length", "block", BLOCK_ROWS)
    need = F.when((F.col("start") > 0) & (F.col("length") > 0), F.col("start") / F.col("length")).otherwise(0.0)
    starts = start_scores(vectors, asked, k).withColumn("need", need * (1 - ROUNDING))
    starts = in_blocks(starts, "need", "query_block", QUERY_BLOCK_ROWS)
    pairs, _ = materialise(spark, useful_pairs(stored, starts), "block-pairs")
    pairs = broadcast_if_small(pairs, pairs.count())
    candidates = stored.join(pairs, ["dimension", "block"])
    asked = starts.join(pairs, ["dimension", "query_block"])
    keys = ["dimension", "block", "query_block"]

    def search(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(asking) and len(block):
            searched = Block(block, k)
            queries = np.stack(asking["vector"].to_numpy())
            found = searched.search(asking["vec_id"].to_numpy(), queries, asking["start"].to_numpy())
            for query_id, (rows, scores) in zip(asking["vec_id"], found, strict=True):
                ids = pd.array(searched.ids[rows], dtype="Int64")
                ids[~searched.known[rows]] = pd.NA
                part = {"query_id": query_id, "vec_id": ids, "score": scores.astype(np.int64)}
                parts.append(pd.DataFrame(part))
        nothing = pd.DataFrame({c: [] for c in ("query_id", "vec_id", "score")}, dtype="Int64")
        return pd.concat(parts) if parts else nothing

    found = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def in_blocks(rows: DataFrame, by: str, name: str, size: int) -> DataFrame:
    """Rows with the number of their block when cut in falling order of a column."""
    placed = rank_all(rows, by, "vec_id", "_place")
    return placed.withColumn(name, F.floor((F.col("_place") - 1) / size).cast("long")).drop("_place")


def useful_pairs(stored: DataFrame, asked: DataFrame) -> DataFrame:
    """dimension, block, query_block where a vector may be long enough for a query.

    Of blocks there are a few thousandths as many as rows; those of the queries
    meet a block in one array per dimension, with a number each.
    """
    longest = stored.groupBy("dimension", "block").agg(F.max("length").alias("longest"))
    least = asked.groupBy("dimension", "query_block").agg(F.min("need").alias("need"))
    listed = least.groupBy("dimension").agg(F.collect_list(F.struct("query_block", "need")).alias("listed"))
    useful = F.filter("listed", lambda one: one["need"] <= F.col("longest") * (1 + ROUNDING))
    return longest.join(listed, "dimension").select(
        "dimension", "block", F.explode(F.transform(useful, lambda one: one["query_block"])).alias("query_block")
    )


def start_scores(stored: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Queries with the k-th best score among the longest vectors, or minus infinity.

    The longest vectors are a fixed number, sent to the tasks with the code.
    """
    longest = stored.orderBy(F.desc("length"), "vec_id").limit(START_ROWS).toPandas()
    by_dimension = {d: Block(rows, k) for d, rows in longest.groupby("dimension")}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            start = pd.Series(-np.inf, index=batch.index)
            for dimension, rows in batch.groupby("dimension"):
                if dimension in by_dimension:
                    queries = np.stack(rows["vector"].to_numpy())
                    unknown = np.full(len(rows), -np.inf)
                    found = by_dimension[dimension].search(rows["vec_id"].to_numpy(), queries, unknown)
                    start[rows.index] = [
                        float(scores[-1]) if len(scores) == k else -np.inf for _, scores in found
                    ]
            yield batch.assign(start=start)

    fields = ", ".join(f"{name} {kind}" for name, kind in asked.dtypes)
    return asked.mapInPandas(score, f"{fields}, start double")
