"""Named queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm import (
    bpe,
    chat,
    collocations,
    exact_dedup,
    html_extraction,
    mixing,
    near_dup,
    pii,
    quality,
    token_alignment,
    topk,
    url_filters,
    warc,
)
from ontime.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

# For the given tables only: keep the key of real data out of the code.
PSEUDONYM_KEY = "a key for the given tables"
VOCABULARY = "byte_bpe_50k.tiktoken"
BYTE_LEVEL_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_source_mix")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents"))


@query("op2_chat_calls")
def chat_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_turns(spark, table(spark, sf_dir, "conversations"))


@query("op5_pseudonyms")
def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(documents, PSEUDONYM_KEY).withColumnRenamed("_n_pii", "n_pii")


@query("op6_url_verdicts")
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = url_filters.rule_table(spark, url_filters.RULES)
    return url_filters.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op7_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(spark, table(spark, sf_dir, "documents"))


@query("op8_near_duplicates")
def near_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return near_dup.near_duplicates(spark, documents, shingle_words=2)


@query("op9_warc_fixity")
def warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit a replica in which some records are damaged or lost, by their URL's hash."""
    pages = table(spark, sf_dir, "pages")
    record = warc.warc_record(F.col("url"), F.col("html"))
    draw = F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 2)
    damaged = F.concat(F.expr("substring(_record, 1, char_length(_record) - 1)"), F.lit("\x00"))
    digests = pages.select("page_id", "url", record.alias("_record"), draw.alias("_draw")).select(
        "page_id",
        "url",
        F.octet_length("_record").cast("long").alias("n_bytes"),
        F.sha2("_record", 256).alias("digest"),
        F.when(F.col("_draw") < "04", F.sha2(damaged, 256))
        .when(F.col("_draw") >= "08", F.sha2("_record", 256))
        .alias("copy_digest"),
    )
    placed = warc.packed(spark, digests, "n_bytes")
    replicas = placed.select(
        "file",
        "offset",
        F.posexplode(F.array("digest", "copy_digest")).alias("replica", "digest"),
    ).where("digest IS NOT NULL")
    found = warc.audit(spark, replicas)
    named = placed.select(
        "page_id",
        "url",
        "n_bytes",
        F.col("file").alias("p_file"),
        F.col("offset").alias("p_offset"),
    )
    return found.join(
        named, (F.col("file") == F.col("p_file")) & (F.col("offset") == F.col("p_offset"))
    ).select("page_id", "url", "n_bytes", "status", "digest_0", "digest_1")


@query("op3_main_texts")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_texts(spark, table(spark, sf_dir, "pages"))


@query("op4_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return bpe.token_digests(
        spark, documents, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    )


@query("op10_exact_top_k")
def top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(spark, vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op13_exact_duplicates")
def exact_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, table(spark, sf_dir, "documents"))


@query("op11_collocations")
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def token_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return token_alignment.aligned_documents(
        spark,
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_LEVEL_TOKENIZER),
        public_tokenizers.path(PIECE_TOKENIZER),
        outputs={"groups_sha256": digest},
    )
