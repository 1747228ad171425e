from __future__ import annotations

import collections
import hashlib
import json
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ontime.llm import token_alignment
from ontime.llm.catalog import BYTE_LEVEL_TOKENIZER, PIECE_TOKENIZER, QUERIES

LEFT = public_tokenizers.path(BYTE_LEVEL_TOKENIZER)
RIGHT = public_tokenizers.path(PIECE_TOKENIZER)


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


def spans(pieces):
    at, found = 0, []
    for piece in pieces:
        found.append((at, at + len(piece)))
        at += len(piece)
    return found


def whole(text, libraries):
    """Groups and linked pairs of a whole text, by comparing every two tokens that are near."""
    left, right = libraries
    if not text:
        return None
    a = left.encode(" " + text, add_special_tokens=False).ids
    b = right.encode(text)
    alphabet = token_alignment.byte_level_alphabet()
    a_bytes = [bytes(alphabet[c] for c in left.id_to_token(n)) for n in a]
    b_bytes = [
        bytes([int(right.id_to_piece(n)[3:5], 16)])
        if right.is_byte(n)
        else right.id_to_piece(n).replace("▁", " ").encode()
        for n in b
    ]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    a_spans, b_spans = spans(a_bytes), spans(b_bytes)
    ends = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
    groups, pairs, start = [], [], 0
    for end in ends:
        some = [(n, s) for n, s in zip(a, a_spans) if start < s[1] <= end]
        others = [(n, s) for n, s in zip(b, b_spans) if start < s[1] <= end]
        groups.append(",".join(str(n) for n, _ in some) + "|" + ",".join(str(n) for n, _ in others))
        start = end
        pairs += [
            (n, m) for n, s in some for m, t in others if max(s[0], t[0]) < min(s[1], t[1])
        ]
    return len(a), len(b), ";".join(groups), len(groups), pairs


def expected(rows, libraries):
    found = [(key, whole(text, libraries)) for key, text in rows]
    counts = collections.Counter(pair for _, one in found if one for pair in set(one[4]))
    most = collections.defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return sorted(
        (
            (key, 0, 0, 0, 0, 0, 0, "")
            if one is None
            else (
                key,
                one[0],
                one[1],
                one[3],
                len(one[4]),
                sum(counts[p] == most[p[0]] for p in one[4]),
                sum(counts[p] for p in one[4]),
                one[2],
            )
            for key, one in found
        ),
        key=repr,
    )


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def result(df, last="groups"):
    return sorted((tuple(row) for row in df.select(*NAMES, last).collect()), key=repr)


def test_given_documents_whole(spark, small_dir, libraries):
    texts = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    # Comparing all tokens of a group with all is for texts of a bounded length.
    digested = [
        (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[1] else "")
        for row in expected([tuple(r) for r in texts if len(r.text or "") < 6000], libraries)
    ]
    df = spark.read.parquet(f"{small_dir}/documents.parquet").where(
        F.coalesce(F.char_length("text"), F.lit(0)) < 6000
    )
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    found = token_alignment.aligned_documents(spark, df, LEFT, RIGHT, outputs={"sha": digest})
    assert result(found, "sha") == sorted(digested, key=repr)


def test_the_query_gives_a_row_for_each_document(spark, small_dir):
    documents = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = QUERIES["op12_token_alignment"](spark, small_dir)
    assert set(rows.columns) == {*NAMES, "groups_sha256"}
    assert dict(rows.dtypes) == dict.fromkeys(NAMES, "bigint") | {"groups_sha256": "string"}
    found = {row.doc_id: row for row in rows.collect()}
    assert len(found) == documents.count()
    assert all(row.n_links == row.n_a + row.n_b - row.n_groups for row in found.values())


ODD = [
    None,
    "",
    " ",
    "a",
    " a ",
    "a  b",
    "a b c",
    "tab\tand\r\nline \n end",
    "<|endoftext|> x <s> </s> <unk> <0x41>",
    "▁ piece of space",
    "x ▁y",
    "naïve café 你好 \U0001f600\U0001f468‍\U0001f469",
    "\x00 nul \x1c sep",
    "don't we'll 's 'S",
    "1234567 12 3.5e10",
    "́ combining ﬁ",
    "word" * 500,
    "a" * 3000,
    "{ } ( );\r\n\t\tif",
]


@pytest.mark.parametrize("block_links", [1, 30, 2_000_000])
def test_odd_texts_and_small_blocks(spark, libraries, monkeypatch, block_links):
    monkeypatch.setattr(token_alignment, "BLOCK_LINKS", block_links)
    draw = random.Random(3)
    words = " ".join(t for t in ODD if t and "▁" not in t).split(" ")
    rows = [(n, text) for n, text in enumerate(ODD)]
    rows += [(100 + n, " ".join(draw.choices(words, k=draw.randrange(1, 30)))) for n in range(60)]
    rows += [(None, "no key here"), (7, "again the same key"), (7, "again the same key")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"block": F.lit("x"), "groups": F.lit(1), "key": F.lit(2.0)}
    )
    found = token_alignment.aligned_documents(spark, df.repartition(3), LEFT, RIGHT)
    assert result(found) == expected(rows, libraries)


def test_cached_chunks_may_be_cleared(spark, libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHED_CHUNKS", 5)
    monkeypatch.setattr(token_alignment, "LEARNT_CHUNKS", 2)
    rows = [(n, f"some {n % 7} words {n} of text") for n in range(40)]
    aligner = token_alignment.Aligner(LEFT, RIGHT)
    found = [d for _, text in rows for d in aligner.documents([text])]
    assert [d[3] for d in found] == [whole(text, libraries)[2] for _, text in rows]


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    found = token_alignment.aligned_documents(spark, df, LEFT, RIGHT)
    assert set(found.columns) == {*NAMES, "groups"}
    assert found.collect() == []


def test_alphabet_spells_every_byte():
    alphabet = token_alignment.byte_level_alphabet()
    assert sorted(alphabet.values()) == list(range(256))
    with open(LEFT, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    assert alphabet["Ġ"] == 32 and alphabet["Ċ"] == 10
    assert set(alphabet) == {token for token in vocabulary if len(token) == 1}
