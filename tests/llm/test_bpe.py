from __future__ import annotations

import hashlib
import random
import struct
import subprocess
import sys
import time
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

from ontime.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def codec(ranks):
    return bpe.Codec(ranks, PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed):
    rnd = random.Random(seed)
    alphabet = "aab  \n\t'sé1　 ß漢😀\x1c\x85!?\r\x0b" + "".join(chr(rnd.randrange(0x20, 0xD7FF)) for _ in range(40))
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(60))) for _ in range(400)]


FIXED = ["", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "don't we'll 'S", "aaaaaaaaaaaaaaa" * 40, "<|endoftext|>", "x y\n\nz", "word " * 40_000]


@pytest.mark.parametrize("seed", range(3))
def test_same_ids_and_bytes_as_the_library(codec, library, seed, monkeypatch):
    monkeypatch.setattr(bpe, "DECODE_TOKENS", 700)
    monkeypatch.setattr(bpe, "ENCODE_WORDS", 90)
    for group in bpe.groups([*texts(seed), *FIXED]):
        for text, (ids, decoded) in zip(group, codec.encode(group), strict=True):
            expected = library.encode_ordinary(text)
            assert ids == struct.pack(f"<{len(expected)}I", *expected)
            assert decoded == text.encode()


def test_full_caches_are_emptied(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 20)
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 20)
    codec = bpe.Codec(ranks, PATTERN)
    for text in texts(7):
        ((ids, _),) = codec.encode([text])
        expected = library.encode_ordinary(text)
        assert ids == struct.pack(f"<{len(expected)}I", *expected)


def test_table_with_nulls_repeats_and_other_columns(spark, library):
    rows = [(1, None), (1, ""), (None, "a b"), (3, "same"), (3, "same"), (4, "é " * 50_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_tokens string")
    found = bpe.token_digests(spark, docs, PATH, PATTERN).collect()
    key = lambda r: (r[0] or 0, r[1])
    expected = []
    for k, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        expected.append((k, len(ids), packed, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert bpe.token_digests(spark, docs.where("false"), PATH, PATTERN).collect() == []


@pytest.mark.parametrize("alphabet", ["ACGT", "ab", "a", "aeinrstghl", "ng", "日本é", "0123456789abcdef"])
def test_long_words_many_pairs_to_a_step(codec, library, alphabet, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_WORD", 1)
    monkeypatch.setattr(bpe, "LONG_BYTES", 1500)
    rnd = random.Random(alphabet)
    words = ["".join(rnd.choices(alphabet, k=n)) for n in (1, 2, 3, 4, 7, 30, 200, 700) for _ in range(5)]
    found = codec.merged(list(dict.fromkeys(words)))
    for word in words:
        ids = library._encode_single_piece(word.encode())
        assert found[word] == struct.pack(f"<{len(ids)}I", *ids)


def test_one_word_of_many_letters(ranks, library):
    """A run of 100,000 letters: steps go with the ranks in it, not with its length."""
    rnd = random.Random(5)
    word = "".join(rnd.choices("ACGT", k=100_000))
    ((ids, decoded),) = bpe.Codec(ranks, PATTERN).encode([word])
    expected = library.encode_ordinary(word)
    assert ids == struct.pack(f"<{len(expected)}I", *expected)
    assert decoded == word.encode()


def new_words(seed, count):
    rnd = random.Random(seed)
    parts = "th er on an re he in nd ha en ou ti at es st er de un".split()
    return list(dict.fromkeys("".join(rnd.choices(parts, k=6)) for _ in range(count)))


def plain_ids(word, ranks):
    """One contraction after another, in a loop."""
    tokens = [bytes([b]) for b in word.encode()]
    while True:
        made = [(ranks[a + b], n) for n, (a, b) in enumerate(zip(tokens[:-1], tokens[1:], strict=True)) if a + b in ranks]
        if not made:
            return [ranks[t] for t in tokens]
        at = min(made)[1]
        tokens[at : at + 2] = [tokens[at] + tokens[at + 1]]


def test_new_words_cost_a_third_of_a_plain_loop_at_most(ranks, codec):
    words = new_words(3, 20_000)
    began = time.process_time()
    expected = [plain_ids(word, ranks) for word in words]
    plain = time.process_time() - began
    began = time.process_time()
    found = codec.merged(words)
    codec.decode(list(found.values()))
    taken = time.process_time() - began
    assert [found[w] for w in words] == [struct.pack(f"<{len(ids)}I", *ids) for ids in expected]
    assert 3 * taken < plain


def test_pairs_of_smaller_rank_made_on_the_way():
    """Ranks that fall with length: a step stops where a new token makes the next pair."""
    rnd = random.Random(11)
    single = {bytes([b]): 1000 + b for b in range(256)}
    for _ in range(60):
        long = {"".join(rnd.choices("ab", k=rnd.randrange(2, 7))).encode() for _ in range(25)}
        own = single | dict(zip(sorted(long), rnd.sample(range(900), len(long)), strict=True))
        codec = bpe.Codec(own, PATTERN)
        words = list({"".join(rnd.choices("ab", k=rnd.randrange(1, 40))) for _ in range(40)})
        for word, ids in codec.merged(words).items():
            expected = [own[word.encode()]] if word.encode() in own else plain_ids(word, own)
            assert ids == struct.pack(f"<{len(expected)}I", *expected)


GROWN = """
import public_tokenizers
from ontime.llm import bpe
from tests.llm.test_bpe import new_words

def own():
    with open("/proc/self/smaps_rollup") as lines:
        return sum(int(line.split()[1]) for line in lines if line.startswith(("Pss_Anon", "Pss_Shmem"))) / 1024

ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
before = most = own()
codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
for seed in range(16):
    codec.encode([" ".join(new_words(seed, 40_000))])
    most = max(most, own())
print(most - before)
"""


def test_memory_of_a_worker_that_meets_many_words():
    """640,000 chunks, more than are kept: vocabulary, caches and a group of texts."""
    top = Path(__file__).parents[2]
    said = subprocess.run([sys.executable, "-B", "-c", GROWN], cwd=top, capture_output=True, text=True, check=True)
    assert float(said.stdout.split()[-1]) < 160
