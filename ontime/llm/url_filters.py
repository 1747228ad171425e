"""URL filters: host suffixes and path prefixes met by short hashes.

Each URL becomes the expressions (host suffix + path prefix) that a rule could
have. Expressions meet rules in an equi-join on a short hash; the full digest
then confirms the match, and the longest confirmed rule decides.

Defined results: a null URL or one without `://` has an empty host and path
and meets no rule; of rules of one length the one with the longer host wins,
then `block`; a URL without a rule is allowed; repeated rows each have their
result; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import LOWER, UPPER, broadcast_if_small

# Fixed values of the contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT_VERDICT = "allow"
SHORT_HASH_DIGITS = 8


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table with their hashes; any DataFrame of this form will do."""
    table = spark.createDataFrame(
        [tuple(rule) for rule in rules], "r_verdict string, r_host string, r_path string"
    )
    return with_hashes(table)


def with_hashes(rules: DataFrame) -> DataFrame:
    digest = F.sha2(F.concat_ws("\n", "r_host", "r_path"), 256)
    return rules.withColumn("r_digest", digest).withColumn(
        "r_short", F.substring(digest, 1, SHORT_HASH_DIGITS)
    )


def suffixes(name: Column) -> Column:
    labels = F.split(name, r"\.")
    size = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(labels, i, size), ".")
    )


def judge_urls(
    urls: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, url: str = "url"
) -> DataFrame:
    """Each row's host, path, deciding rule (or null) and verdict, beside its own columns.

    Only distinct (host, path) pairs are expanded. Path prefixes are cut at the
    lengths that rules have, a list no longer than the longest rule path.
    """
    lengths = sorted(
        row[0] for row in rules.select(F.char_length("r_path")).distinct().collect() if row[0] is not None
    )
    kept = F.struct(*(F.col(f"`{name}`") for name in urls.columns)).alias("kept")
    rows = urls.select(kept, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    expressions = (
        rows.select("host", "path")
        .distinct()
        .where(F.col("host") != "")
        .select("host", "path", F.explode(F.array_distinct(suffixes(F.col("host")))).alias("suffix"))
        .select(
            "*", F.explode(F.array(*(F.lit(n).cast("int") for n in lengths)) if lengths else F.array().cast("array<int>")).alias("length")
        )
        .where(F.col("length") <= F.char_length("path"))
        .withColumn(
            "digest",
            F.sha2(F.concat_ws("\n", "suffix", F.expr("substring(path, 1, length)")), 256),
        )
    )
    decided = (
        expressions.join(
            broadcast_if_small(rules, rules.count()),
            F.substring("digest", 1, SHORT_HASH_DIGITS) == F.col("r_short"),
        )
        .where(F.col("digest") == F.col("r_digest"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.char_length("r_host") + F.char_length("r_path")).alias("size"),
                    F.char_length("r_host").alias("host_size"),
                    F.col("r_verdict").alias("verdict"),
                    F.concat("r_host", "r_path").alias("rule"),
                )
            ).alias("best")
        )
        .select(F.col("host").alias("d_host"), F.col("path").alias("d_path"), "best")
    )
    return rows.join(
        decided,
        (F.col("host") == F.col("d_host")) & (F.col("path") == F.col("d_path")),
        "left",
    ).select(
        "kept.*",
        F.col("host"),
        F.col("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
