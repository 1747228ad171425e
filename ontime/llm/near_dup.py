"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

A document is the set of its word shingles; equal sets are one class from the
start. In a SuperMinHash signature each shingle has a random permutation of
the slots, and brings to each slot its rank there plus a random fraction; a
slot keeps the least. Rank by rank, a slot that is filled never changes again,
so a signature is complete after the few ranks that fill all slots. The
permutations are affine maps modulo a prime number of slots: any two slots
have the same joint distribution of ranks as under random permutations, so
the estimate is unbiased with SuperMinHash's lower variance.

Classes that agree in all slots of a band are candidates. With 38 bands of 5
slots, two sets of similarity 0.8 miss each other with probability 3e-7 if
slots are taken as independent; in tiny sets they are not, so sets of up to
`TINY_SET` shingles are all candidates of each other.

A bucket never gives all its pairs. First each member meets one member of the
bucket that is picked by a hash, another one in each band; links are confirmed
on full sets, and labels spread over them. Then the members of buckets that
still hold several groups are compared by prefix filtering: in an order of
shingles from rare to frequent, two sets that are similar enough share one of
the first few shingles of either, fewer of the smaller one. Documents that
have a template in common but are not similar enough have none in common
there, and meet nobody. What does meet is compared in blocks of fixed size:
those outside the largest group of a shingle with all members of other groups,
giving only links that join groups. So groups are as if all candidates had
been compared, while a large group of near copies costs few pairs. The order
comes from counts over a bounded sample of the sets; it has no influence on
the result, only on how many meet.

Defined results: null and blank texts have no shingles and are linked with
nothing; texts with fewer words than a shingle are one shingle; repeated rows
are copies; a null key stays a row of its own and never names a group; an
empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import broadcast_if_small, drop_folders, materialise
from ontime.session import temporary_folders, work_folder

# A prime number of slots; the bands use all but the last.
SLOTS = 191
BAND_SLOTS = 5
BANDS = 38
BLOCK_MEMBERS = 256
# Signatures of sets up to this size are made from all ranks at once.
SMALL_SET = 48
CACHED_WORDS = 200_000
# Sets that are compared with all others of their size, band or no band.
TINY_SET = 25
# Sets whose shingles are counted for an order, and shingles that have a place
# in it by their count, 16 bytes each, which go to every task.
SAMPLE_SETS = 50_000
FREQUENT_SHINGLES = 500_000

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
INVERSES = np.array([0] + [pow(b, -1, SLOTS) for b in range(1, SLOTS)])
RANK_SHIFT = np.uint64(56)


def mixed(values: np.ndarray) -> np.ndarray:
    """A finalising hash of arrays of 64-bit integers, which wrap around."""
    values = (values ^ (values >> np.uint64(30))) * MIX_A
    values = (values ^ (values >> np.uint64(27))) * MIX_B
    return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


WORD_HASHES = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text.

    Bytes are lower-cased and split as ASCII, which is what the contract asks
    for: A-Z alone change case, and only the six ASCII blanks part words.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, found), np.uint64, len(found))
    n = max(1, len(hashes) - size + 1)
    width = min(size, len(hashes))
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total = mixed(total * STEP + hashes[k : k + n])
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    """SuperMinHash: per slot, the least of rank and random fraction over all shingles."""
    first = mixed(shingles + STEP)
    offset = (first % np.uint64(SLOTS)).astype(np.int64)
    stride = (mixed(first) % np.uint64(SLOTS - 1)).astype(np.int64) + 1
    if len(shingles) <= SMALL_SET:
        # The rank of slot s under rank -> offset + stride * rank.
        ranks = (np.arange(SLOTS)[None, :] - offset[:, None]) * INVERSES[stride][:, None] % SLOTS
        values = fractions(shingles[:, None], ranks.astype(np.uint64))
        return values.min(axis=0)
    slots = np.full(SLOTS, np.uint64(2**64 - 1))
    for rank in range(SLOTS):
        at = (offset + stride * rank) % SLOTS
        open_slots = slots[at] == np.uint64(2**64 - 1) if rank else np.ones(len(at), bool)
        at = at[open_slots]
        values = fractions(shingles[open_slots], np.full(len(at), rank, np.uint64))
        # The last write to a slot stays, so the largest goes first.
        order = np.argsort(values)[::-1]
        slots[at[order]] = values[order]
        if slots.max() != np.uint64(2**64 - 1):
            break
    return slots


def fractions(shingles: np.ndarray, rank) -> np.ndarray:
    """Rank in the upper 8 bits, a random fraction for it in the others."""
    fraction = mixed(mixed(shingles + np.uint64(1)) + rank * STEP) >> np.uint64(8)
    return (rank << RANK_SHIFT) | fraction


def band_keys(slots: np.ndarray) -> np.ndarray:
    """One 63-bit key per band, which holds the number of the band."""
    rows = slots[: BANDS * BAND_SLOTS].reshape(BANDS, BAND_SLOTS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_SLOTS):
        keys = mixed(keys * STEP + rows[:, k])
    return (keys >> np.uint64(1)).astype(np.int64)


SIGNED = "doc_id long, n_shingles long, set_key binary, bands array<long>"


def signed(docs: DataFrame, size: int) -> DataFrame:
    """Per row: size and fingerprint of its set, and its band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, size) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, sets), pa.int64(), size=len(sets)),
                    pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                    pa.array([band_keys(signature(s)) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(sign, SIGNED)


def classes(rows: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: the least doc_id, size and band keys."""
    return (
        rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("least"))
        .select("least.*")
        .withColumnRenamed("doc_id", "rep")
    )


def shared_ids(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(a, b): representatives of classes that hold rows of one doc_id."""
    named = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).select("doc_id", "set_key")
    repeated = (
        named.groupBy(F.col("doc_id").alias("r_id"))
        .agg(F.min("set_key").alias("least"), F.max("set_key").alias("greatest"))
        .where("least <> greatest")
        .select("r_id")
    )
    repeated, _ = materialise(spark, repeated, "repeated-ids")
    of_ids = named.join(broadcast_if_small(repeated, repeated.count()), F.col("doc_id") == F.col("r_id")).distinct()
    reps = named.groupBy(F.col("set_key").alias("c_key")).agg(F.min("doc_id").alias("a"))
    # The least doc_id of a class and each repeated one in it are one group.
    edges = of_ids.join(reps, F.col("set_key") == F.col("c_key")).select("a", F.col("doc_id").alias("b"))
    return edges.where("a <> b").distinct()


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be as similar as `percent`."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def bucket_members(reps: DataFrame) -> DataFrame:
    """(bucket, rep, n_shingles, bucket size, picked member) of buckets with several members."""
    rows = reps.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    shared = (
        rows.groupBy("bucket")
        .agg(
            F.count("*").alias("members"),
            F.min(F.struct(F.xxhash64("rep", "bucket").alias("draw"), "rep", "n_shingles")).alias("picked"),
        )
        .where("members > 1")
        .select(F.col("bucket").alias("b_bucket"), "members", "picked")
    )
    return rows.join(shared, F.col("bucket") == F.col("b_bucket")).drop("b_bucket")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """rep and its sorted shingles, computed again from the texts of these documents."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, size).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["s_rep", "shingles"]
            )

    texts = docs.select("doc_id", "text").join(
        wanted.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"
    )
    return texts.mapInArrow(shingle, "s_rep long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as `percent`."""
    left = sets.select(F.col("s_rep").alias("a"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("s_rep").alias("b"), F.col("shingles").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - common
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(100 * common >= percent * union)
        .select("a", "b")
        .distinct()
    )


def components(spark: SparkSession, edges: DataFrame, purpose: str) -> DataFrame:
    """(node, label): the least node of each component, by alternating stars.

    A large star moves a node's greater neighbours to its least one, a small
    star moves its lesser ones; both keep components, and what remains when
    nothing changes is one star around the least node of each component. The
    work is an aggregate and a join per star; no node's neighbours have to be
    in one place.
    """
    directed = edges.select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")
    ).where("v <> u").distinct()
    stars, folder = materialise(spark, directed, purpose)
    state = star_state(stars)
    while state[0]:
        both = stars.select("v", "u").union(stars.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy(F.col("v").alias("c")).agg(F.least(F.min("u"), F.min("v")).alias("m"))
        large = both.join(least, F.col("v") == F.col("c")).where("u > v").select(
            F.col("u").alias("v"), F.col("m").alias("u")
        )
        large = large.where("v <> u").distinct()
        lesser = large.groupBy(F.col("v").alias("c")).agg(F.min("u").alias("m"))
        small = large.join(lesser, F.col("v") == F.col("c")).select(
            F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")
        )
        small = small.select("e.*").where("v <> u").distinct()
        used, before = folder, state
        stars, folder = materialise(spark, small, purpose)
        drop_folders(spark, [used])
        state = star_state(stars)
        if state == before:
            break
    roots = stars.select(F.col("u").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return stars.select(F.col("v").alias("node"), F.col("u").alias("label")).union(roots)


def star_state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    digest = F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    names = labels.select(F.col("node").alias("l_node"), F.col("label").alias("l_label"))
    return members.join(names, F.col("rep") == F.col("l_node"), "left").select(
        *members.columns, F.coalesce("l_label", "rep").alias("label")
    )


def open_members(members: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, label) of sets in buckets that hold several groups, and of tiny sets."""
    named = labelled(members.where("members > 2").select("bucket", "rep"), labels)
    several = (
        named.groupBy(F.col("bucket").alias("g_bucket"))
        .agg(F.min("label").alias("least"), F.max("label").alias("greatest"))
        .where("least <> greatest")
        .select("g_bucket")
    )
    met = named.join(several, F.col("bucket") == F.col("g_bucket"), "left_semi").select("rep", "label")
    tiny = labelled(reps.where(F.col("n_shingles") <= TINY_SET).select("rep"), labels)
    return met.union(tiny).distinct()


def frequent_shingles(sets: DataFrame, n_sets: int) -> np.ndarray:
    """The shingles of most sets in a sample, from less to more frequent."""
    every = max(1, n_sets // SAMPLE_SETS)
    counted = (
        sets.where(F.pmod(F.xxhash64("rep"), F.lit(every)) == 0)
        .select(F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .count()
        .where("count > 1")
    )
    rows = counted.orderBy(F.desc("count"), "shingle").limit(FREQUENT_SHINGLES).toArrow()
    return rows.column("shingle").to_numpy()[::-1].astype(np.int64)


def prefix_lengths(size: int, percent: int) -> tuple[int, int]:
    """Of a set, how many first shingles a larger and a smaller partner may look at.

    A set of similarity `percent` and of at least this size shares so many
    shingles that one is among the first few of this one; as the larger one of
    a pair, a set needs some more.
    """
    as_smaller = size + (-2 * percent * size) // (100 + percent) + 1
    as_larger = size + (-percent * size) // 100 + 1
    return as_smaller, as_larger


PREFIX = "token long, rep long, label long, n_shingles long, smaller boolean"


def prefix_rows(opened: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """The first shingles of each open set in the order from rare to frequent."""
    by_value = np.argsort(frequent)
    known = frequent[by_value]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, owners, smaller = [], [], []
            for row, shingles in enumerate(batch.column(2)):
                own = shingles.values.to_numpy()
                order = np.arange(len(own))
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    rank = np.where(known[at] == own, by_value[at] + 1, 0)
                    order = np.lexsort((own, rank))
                as_smaller, as_larger = prefix_lengths(len(own), percent)
                tokens.append(own[order[:as_larger]])
                owners.append(np.full(len(tokens[-1]), row))
                smaller.append(np.arange(len(tokens[-1])) < as_smaller)
            if not tokens:
                continue
            owner = pa.array(np.concatenate(owners))
            sizes = pc.list_value_length(batch.column(2)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens)),
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    sizes.take(owner),
                    pa.array(np.concatenate(smaller)),
                ],
                ["token", "rep", "label", "n_shingles", "smaller"],
            )

    return opened.select("rep", "label", "shingles").mapInArrow(first, PREFIX)


def open_clusters(prefixes: DataFrame) -> DataFrame:
    """Sets that share a first shingle with another group, by that shingle's largest group.

    (cluster, rep, label, outside): once for each cluster, which is a group
    together with all that meets it at a shingle where it is the largest;
    `outside` are those of other groups.
    """
    groups = prefixes.groupBy("token", "label").agg(F.count("*").alias("n"), F.max("smaller").alias("smaller"))
    largest = (
        groups.groupBy(F.col("token").alias("g_token"))
        .agg(
            F.count("*").alias("groups"),
            F.max("smaller").alias("smaller"),
            F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("main"),
        )
        .where("groups > 1 AND smaller")
        .select("g_token", F.col("main.label").alias("cluster"))
    )
    return (
        prefixes.join(largest, F.col("token") == F.col("g_token"))
        .select("cluster", "rep", "label", (F.col("label") != F.col("cluster")).alias("outside"))
        .distinct()
    )


def block_links(percent: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Links between a block of outside members and a block of all, one per pair of groups."""

    def link(outside: pd.DataFrame, everyone: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        parent: dict[int, int] = {}

        def root(label: int) -> int:
            while parent.setdefault(label, label) != label:
                parent[label] = parent[parent[label]]
                label = parent[label]
            return label

        if len(outside) and len(everyone):
            sets = [np.asarray(s) for s in everyone["shingles"]]
            sizes = np.array([len(s) for s in sets])
            flat, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
            labels = everyone["label"].to_numpy()
            for label, shingles in zip(outside["label"], outside["shingles"], strict=True):
                own = np.sort(np.asarray(shingles))
                # Positions of all members' shingles in this set, then hits by member.
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                common = np.add.reduceat((own[at] == flat).astype(np.int64), starts)
                near = 100 * common >= percent * (len(own) + sizes - common)
                for other in set(labels[near].tolist()):
                    if root(label) != root(other):
                        parent[root(label)] = root(other)
                        links.append((label, other))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return link


def cluster_links(clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): labels of groups that a pair inside an open cluster links."""
    sizes = clusters.groupBy(F.col("cluster").alias("z_cluster")).agg(
        F.ceil(F.count("*") / BLOCK_MEMBERS).cast("int").alias("blocks"),
        F.ceil(F.count_if("outside") / BLOCK_MEMBERS).cast("int").alias("out_blocks"),
    )
    rows = (
        clusters.join(sizes, F.col("cluster") == F.col("z_cluster"))
        .join(sets, F.col("rep") == F.col("s_rep"))
        .select("cluster", "label", "outside", "shingles", "blocks", "out_blocks", F.xxhash64("rep").alias("draw"))
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = rows.where("outside").select(
        "cluster",
        "label",
        "shingles",
        F.pmod("draw", "out_blocks").cast("int").alias("out_block"),
        every("blocks").alias("block"),
    ).toDF("cluster", "label", "shingles", "out_block", "block")
    everyone = rows.select(
        "cluster",
        "label",
        "shingles",
        F.pmod("draw", "blocks").cast("int").alias("block"),
        every("out_blocks").alias("out_block"),
    )
    keys = ["cluster", "out_block", "block"]
    return (
        asked.groupBy(*keys)
        .cogroup(everyone.groupBy(*keys))
        .applyInPandas(block_links(percent), "a long, b long")
        .distinct()
    )


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least linked doc_id) and kept.

    Rows that share a doc_id count as linked. Intermediate tables hold keys,
    sizes and band keys; shingles are computed again for candidates alone. Each
    table goes once those made from it are written, but those the result reads.
    """
    rows, _ = materialise(spark, signed(docs, shingle_words), "signed")
    reps, _ = materialise(spark, classes(rows), "classes")
    members, buckets = materialise(spark, bucket_members(reps), "buckets")
    pairs = members.where("rep <> picked.rep").select(
        F.least("rep", "picked.rep").alias("a"),
        F.greatest("rep", "picked.rep").alias("b"),
        "n_shingles",
        F.col("picked.n_shingles").alias("picked_shingles"),
    )
    pairs = pairs.where(may_link("n_shingles", "picked_shingles", percent)).select("a", "b").distinct()
    pairs, candidates = materialise(spark, pairs, "pairs")
    tiny = reps.where(F.col("n_shingles") <= TINY_SET).select("rep")
    wanted = members.select("rep").union(tiny).distinct()
    sets, full_sets = materialise(spark, sets_of(docs, wanted, shingle_words), "sets")
    edges = confirmed(pairs, sets, percent).union(shared_ids(spark, rows))
    first = components(spark, edges, "groups")
    first, _ = materialise(spark, first, "labels")
    opened = open_members(members, first, reps).join(sets, F.col("rep") == F.col("s_rep")).drop("s_rep")
    opened, open_sets = materialise(spark, opened, "open-sets")
    drop_folders(spark, [buckets, candidates])
    prefixes = prefix_rows(opened, frequent_shingles(opened, opened.count()), percent)
    prefixes, first_shingles = materialise(spark, prefixes, "prefixes")
    drop_folders(spark, [open_sets])
    clusters, met = materialise(spark, open_clusters(prefixes), "clusters")
    drop_folders(spark, [first_shingles])
    joined = components(spark, cluster_links(clusters, sets, percent), "joined-groups")
    drop_folders(spark, [full_sets, met])
    joined = joined.select(F.col("node").alias("j_node"), F.col("label").alias("j_label"))
    named = (
        labelled(reps.select("rep").distinct(), first)
        .join(joined, F.col("label") == F.col("j_node"), "left")
        .select("rep", F.coalesce("j_label", "label").alias("component"))
    )
    of_class = (
        rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy(F.col("set_key").alias("c_key"))
        .agg(F.min("doc_id").alias("c_rep"))
        .join(named, F.col("c_rep") == F.col("rep"))
        .select("c_key", "component")
    )
    linked = rows.join(
        of_class,
        (F.col("set_key") == F.col("c_key")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(),
        "left",
    )
    component = F.coalesce("component", "doc_id")
    return linked.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def free_name(name: str, columns: list[str]) -> str:
    """A column name that the table does not have, whatever the case of its letters."""
    taken = {column.lower() for column in columns}
    while name in taken:
        name += "_"
    return name


def deduplicated(spark: SparkSession, docs: DataFrame, **choices) -> DataFrame:
    """One document of each group, columns kept: the one with the least doc_id,
    null last.

    Rows are numbered, and the number is the key, so that documents that share
    a doc_id but not their text all stay, and of equal rows one does.
    """
    number = free_name("_row", docs.columns)
    numbered, _ = materialise(spark, docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    own = numbered.select(F.col(number).alias("doc_id"), F.col("`text`").alias("text"))
    folder = work_folder(spark, "near-duplicates")
    with temporary_folders(spark):
        found = near_duplicates(spark, own, **choices)
        found.write.parquet(folder)
    report = spark.read.schema(found.schema).parquet(folder)
    groups = report.join(
        report.where(~F.col("kept")).select("component_id").distinct(), "component_id", "left_semi"
    ).select("component_id", F.col("doc_id").alias("n_row"))
    ids = numbered.select(F.col(number).alias("n_row"), F.col("`doc_id`").alias("n_id"))
    rank = F.struct(F.col("n_id").isNull().alias("none"), "n_id", "n_row")
    chosen = (
        groups.join(ids, "n_row").groupBy("component_id").agg(F.min(rank)["n_row"].alias("n_row"))
    )
    gone = groups.join(chosen.select("n_row"), "n_row", "left_anti").select(F.col("n_row").alias(number))
    gone, _ = materialise(spark, gone, "gone")
    # Only a list of too many rows makes whole texts travel.
    return numbered.join(broadcast_if_small(gone, gone.count()), number, "left_anti").drop(number)
