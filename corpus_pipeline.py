"""A corpus pipeline: quality rules, near-duplicates, privacy, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm import bpe, mixing, near_dup, pii, quality
from ontime.llm.catalog import PSEUDONYM_KEY, VOCABULARY
from ontime.session import work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def counted(docs: DataFrame) -> DataFrame:
    """The column n_chars brought in line with the text, where there is one."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that a host repeats."""
    return counted(quality.quality_documents(spark, docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by shingles of five words."""
    return near_dup.deduplicated(spark, docs)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms."""
    done = pii.pseudonymised(docs, PSEUDONYM_KEY)
    return counted(done.select(*(F.col(f"`{c}`") for c in docs.columns)))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it."""
    return mixing.mixed_documents(spark, docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix: number of tokens, digests of ids and decoded bytes."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.token_digests(spark, docs, path, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("privacy", privacy_stage),
    ("source mix", mix_stage),
    ("tokens", token_stage),
]

# Fingerprints, pseudonyms and token ids cannot be written as SQL for another
# engine; tests/llm compares run() with a plain Python version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return result
        folder = work_folder(spark, f"stage-{number}")
        result.write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
