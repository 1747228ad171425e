"""WARC fixity audit with Merkle trees over ordered offset ranges.

Records lie in files at increasing offsets. The records of one range of
offsets make a leaf, 16 leaves make a node, and so on up to the root of a
file; file roots make the tree of the replica in the same way. Two replicas
are compared from the root: only children of nodes that differ are looked at,
down to the single records. A node depends on at most 16 children, or on the
records of one range of a file, so no group grows with the data, and nothing
but lengths and digests is ever shuffled.

Defined results: null or empty payloads are records with an empty body; equal
records lie at different offsets; a record without a counterpart is `missing`
(not in the second replica) or `extra` (not in the first); an empty store has
no nodes and no findings; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime.llm.common import materialise

RECORDS_PER_FILE = 256
FANOUT_BITS = 4
RANGE_BITS = 14
# Spark keeps the row's position in its split in so many lower bits.
POSITION_BITS = 33


def warc_record(url: Column, payload: Column) -> Column:
    """A resource record as text: header, blank line, body."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def packed(spark: SparkSession, records: DataFrame, length: str) -> DataFrame:
    """Give each record a file number and an offset, in the order of the scan.

    A file takes the next records of one input split, so files stay small
    whatever the keys are. The rows are stored first, since positions follow
    the splits of this one scan.
    """
    placed = records.withColumn("_at", F.monotonically_increasing_id())
    stored, _ = materialise(spark, placed, "warc")
    position = F.col("_at").bitwiseAND((1 << POSITION_BITS) - 1)
    number = F.floor(position / RECORDS_PER_FILE)
    most = stored.agg(F.max(number)).first()[0] or 0
    split = F.shiftright("_at", POSITION_BITS)
    in_file = stored.withColumn("file", F.shiftleft(split, most.bit_length()) + number)
    before = Window.partitionBy("file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long")
    return in_file.withColumn("offset", offset).drop("_at")


def node_hash(children: str) -> Column:
    """The hash of ordered (position, hash) pairs."""
    lines = F.transform(
        F.sort_array(F.collect_list(children)),
        lambda c: F.concat_ws(":", c["at"].cast("string"), c["hash"]),
    )
    return F.sha2(F.array_join(lines, "\n"), 256).alias("hash")


def merkle_levels(spark: SparkSession, records: DataFrame) -> list[tuple[str, DataFrame]]:
    """Stored levels from leaves to roots, each with the key it was merged by.

    `records` has replica, file, offset and digest. First the parts of each
    file are merged until one is left, then the files.
    """
    leaves = (
        records.select(
            "replica",
            "file",
            F.shiftright("offset", RANGE_BITS).alias("part"),
            F.struct(F.col("offset").alias("at"), F.col("digest").alias("hash")).alias("_child"),
        )
        .groupBy("replica", "file", "part")
        .agg(node_hash("_child"))
    )
    levels = [("offset", materialise(spark, leaves, "merkle")[0])]
    most = levels[0][1].agg(F.max("part"), F.max("file")).first()
    for key, largest in zip(("part", "file"), most, strict=True):
        while largest:
            largest >>= FANOUT_BITS
            up = levels[-1][1].select(
                "replica",
                *(F.shiftright(c, FANOUT_BITS).alias(c) if c == key else c for c in ("file", "part")),
                F.struct(F.col(key).alias("at"), "hash").alias("_child"),
            )
            up = up.groupBy("replica", "file", "part").agg(node_hash("_child"))
            levels.append((key, materialise(spark, up, "merkle")[0]))
    return levels


def differing_ranges(levels: list[tuple[str, DataFrame]]) -> DataFrame:
    """The leaves (file, part) whose hashes differ, by descent from the roots."""
    found: DataFrame | None = None
    merged_by = ""
    for key, nodes in reversed(levels):
        if found is not None:
            up = {c: F.shiftright(c, FANOUT_BITS) if c == merged_by else F.col(c) for c in ("file", "part")}
            nodes = nodes.join(
                found, (up["file"] == F.col("s_file")) & (up["part"] == F.col("s_part")), "left_semi"
            )
        found = unequal(nodes, "hash", "file", "part").select(
            F.col("file").alias("s_file"), F.col("part").alias("s_part")
        )
        merged_by = key
    return found


def unequal(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """Keys for which the replicas 0 and 1 do not have the same value."""
    sides = [
        F.max(F.when(F.col("replica") == replica, F.col(value))).alias(f"{value}_{replica}")
        for replica in (0, 1)
    ]
    return rows.groupBy(*keys).agg(*sides).where(
        ~F.col(f"{value}_0").eqNullSafe(F.col(f"{value}_1"))
    )


def audit(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Differing records of the replicas 0 and 1: file, offset, both digests, status.

    `records` has replica, file, offset and digest; only records in offset
    ranges whose leaf hashes differ are compared.
    """
    ranges = differing_ranges(merkle_levels(spark, records))
    suspects = records.join(
        ranges,
        (F.col("file") == F.col("s_file"))
        & (F.shiftright("offset", RANGE_BITS) == F.col("s_part")),
        "left_semi",
    )
    return unequal(suspects, "digest", "file", "offset").withColumn(
        "status",
        F.when(F.col("digest_1").isNull(), "missing")
        .when(F.col("digest_0").isNull(), "extra")
        .otherwise("corrupt"),
    )
