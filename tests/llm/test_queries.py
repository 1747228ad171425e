"""Each corpus query against its SQL, or against a plain Python version."""

from __future__ import annotations

import glob
import hashlib
import os
import struct

import duckdb
import helpers
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as contract
from ontime.llm import bpe
from ontime.llm.catalog import ORACLE, QUERIES, VOCABULARY


@pytest.fixture(scope="module")
def other_engine(small_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{small_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert set(QUERIES) - set(ORACLE) == {"op4_byte_bpe", "op5_pseudonyms", "op12_token_alignment"}


@pytest.mark.parametrize("name", ORACLE)
def test_same_as_sql(name, spark, small_dir, other_engine):
    df = QUERIES[name](spark, small_dir)
    expected = other_engine.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = by_name([tuple(row) for row in df.collect()], df.columns)
    assert got == by_name(expected.fetchall(), expected.columns)


def test_tokens_are_those_of_the_library(spark, small_dir):
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = dict(spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op4_byte_bpe"](spark, small_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_main_texts_of_whole_articles(spark, small_dir):
    pages = dict(spark.read.parquet(f"{small_dir}/pages.parquet").select("page_id", "html").collect())
    for row in QUERIES["op3_main_texts"](spark, small_dir).collect():
        assert row.text == helpers.article(pages[row.page_id])
        assert row.n_chars == len(row.text)
