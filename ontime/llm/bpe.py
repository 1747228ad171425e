"""Byte-level BPE encoding and decoding by merges over arrays inside each partition.

A partition's texts are cut into words by the vocabulary's pattern. The bytes of
words not met before become one array of tokens; a step finds each word's pair
of the smallest rank in the merge table and contracts it from left to right,
for all words at once, until no word has a pair left. Ids are decoded by a look
into the vocabulary's bytes. What lies between two single spaces is encoded once
and its ids are kept; a text's ids are those of its chunks in order, and its
bytes are decoded from all of its ids.

Spark deals out the texts; nothing is shuffled. A task holds one Arrow batch
of texts, bounded caches of ids and the vocabulary, which is one file of
fixed size. Texts are never cut: long ones are decoded in slices of tokens.

Defined results: null is the empty text, with no ids and the digest of no
bytes; repeated rows each have their result; an empty table gives an empty
result; columns other than the key and the text do not matter; lone
surrogates cannot occur, since Spark's strings are UTF-8.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Collection, Iterable, Iterator
from itertools import filterfalse, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Entries of the two caches of a Python worker, some 200 bytes each.
CACHED_WORDS = 150_000
CACHED_CHUNKS = 300_000
# Tokens that are decoded, and words that are encoded, at a time.
DECODE_TOKENS = 100_000
ENCODE_WORDS = 20_000
# Words of more bytes than this are encoded apart, about so many bytes of them
# at a time.
LONG_WORD = 400
LONG_BYTES = 200_000
# Texts are taken from an Arrow batch by so many rows and handled in groups of
# about so many characters.
TAKEN_ROWS = 256
GROUP_CHARS = 2_000_000

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

# A pair that is no token; more than any rank.
NO_PAIR = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_rows(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left, right, merged) for every way to cut a token into two tokens."""
    return [
        (ranks[token[:cut]], ranks[token[cut:]], rank)
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]


class Codec:
    """The vocabulary as arrays, and the ids of words and chunks met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.words: dict[str, bytes] = {}
        self.ids: dict[str, bytes | None] = {}
        # The merge table, sorted by the pair as one number.
        left, right, rank = np.array(merge_rows(ranks), np.int64).reshape(-1, 3).T
        pairs = (left << 32) | right
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(rank[order], NO_PAIR).astype(np.int32)
        # Token n is size[n] bytes of `pieces` from start[n] on.
        tokens = list(ranks)
        numbers = np.fromiter(ranks.values(), np.int64, len(ranks))
        sizes = np.fromiter(map(len, tokens), np.int32, len(tokens))
        self.pieces = np.frombuffer(b"".join(tokens), np.uint8)
        self.start = np.zeros(numbers.max() + 1, np.int32)
        self.size = np.zeros(numbers.max() + 1, np.int32)
        self.start[numbers] = np.cumsum(sizes) - sizes
        self.size[numbers] = sizes

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes, or NO_PAIR."""
        wanted = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], NO_PAIR)

    def merged(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words: one token's own, or by merges, some words at a time."""
        spelt = {word: word.encode() for word in words}
        found = {w: self.ranks[b].to_bytes(4, "little") for w, b in spelt.items() if b in self.ranks}
        rest = [word for word in words if word not in found]
        short = [word for word in rest if len(spelt[word]) <= LONG_WORD]
        for start in range(0, len(short), ENCODE_WORDS):
            found |= self.contracted(short[start : start + ENCODE_WORDS])
        some: list[str] = []
        for word in rest:
            if len(spelt[word]) > LONG_WORD:
                some.append(word)
                if sum(len(spelt[w]) for w in some) >= LONG_BYTES:
                    found |= self.contracted(some)
                    some = []
        return found | self.contracted(some) if some else found

    def contracted(self, words: list[str]) -> dict[str, bytes]:
        """The ids that words come down to when their pairs are contracted."""
        spelt = [word.encode() for word in words]
        sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        token = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        # rank[n] is that of the pair of token n and the next one of its word.
        rank = np.full(len(token), NO_PAIR, np.int32)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self.rank_of(token[inside], token[inside + 1])
        done_words, done_tokens = [], []
        while len(token):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(word)))
            ended = least == NO_PAIR
            if ended.any():
                done_words.append(word[ended])
                done_tokens.append(token[ended])
                word, token, rank, least = (x[~ended] for x in (word, token, rank, least))
            if len(token):
                word, token, rank = self.step(word, token, rank, least)
        order = np.argsort(np.concatenate(done_words), kind="stable")
        flat = np.concatenate(done_tokens)[order].astype("<u4").tobytes()
        ends = [0, *(np.cumsum(np.bincount(np.concatenate(done_words))) * 4).tolist()]
        return {w: flat[a:b] for w, a, b in zip(words, ends[:-1], ends[1:], strict=True)}

    def step(
        self, word: np.ndarray, token: np.ndarray, rank: np.ndarray, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contract pairs of each word's smallest rank; every word has one.

        Those that do not overlap are contracted from left to right, up to the
        first one whose new token makes a pair of a smaller rank still with a
        neighbour, since that pair is next. So the step ends where as many
        single ones would.
        """
        # Of pairs that overlap in a row, the first one, the third and so on.
        at = np.flatnonzero(rank == least)
        heads = np.diff(at, prepend=-2) != 1
        at = at[(at - at[heads][np.cumsum(heads) - 1]) % 2 == 0]
        new = rank[at]
        # New tokens and their old neighbours. A missing one is found outside
        # the word, or is the token itself at an end of the array.
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, len(token) - 1)
        has_before = (before < at) & (word[before] == word[at])
        has_after = (after > at + 1) & (word[after] == word[at])
        left = np.where(has_before, self.rank_of(token[before], new), NO_PAIR)
        right = np.where(has_after, self.rank_of(new, token[after]), NO_PAIR)
        lower = np.minimum(left, right) < new
        # Two new tokens side by side make a pair when the second one is there.
        beside = np.flatnonzero(has_after[:-1] & (at[1:] == at[:-1] + 2))
        double = self.rank_of(new[beside], new[beside])
        lower[beside + 1] |= double < new[beside]
        right[beside] = double
        if lower.any():
            firsts = np.diff(word[at], prepend=-1) != 0
            earlier = np.cumsum(lower) - lower
            taken = earlier == earlier[firsts][np.cumsum(firsts) - 1]
            # The last one taken has its old neighbour to the right.
            last = beside[~taken[beside + 1]]
            right[last] = self.rank_of(new[last], token[after[last]])
            at, new, before, has_before, left, right = (
                x[taken] for x in (at, new, before, has_before, left, right)
            )
        rank[before[has_before]] = left[has_before]
        token[at], rank[at] = new, right
        stays = np.ones(len(token), bool)
        stays[at + 1] = False
        return word[stays], token[stays], rank[stays]

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks that follow a space, and keep their ids.

        Only chunks without a blank at either end are independent of their
        neighbours; others are kept as None, which marks their texts. Letters
        alone are one word with their space, as the pattern has it.
        """
        clean = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        self.ids.update(dict.fromkeys(chunks - set(clean)))
        spelt = [[" " + c] if c.isalpha() else self.split(" " + c) for c in clean]
        ids = self.joined(spelt, {words[0] for words in spelt if len(words) == 1})
        self.ids.update(zip(clean, ids, strict=True))

    def joined(self, spelt: list[list[str]], passing: Collection[str] = ()) -> list[bytes]:
        """Ids of texts given as words. Words are kept, but for `passing` ones."""
        known: dict[str, bytes] = {}
        fresh = []
        for word in {word for words in spelt for word in words}:
            ids = self.words.get(word) or (self.ids.get(word[1:]) if word[0] == " " else None)
            if ids:
                known[word] = ids
            else:
                fresh.append(word)
        known |= (new := self.merged(fresh))
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        self.words.update((word, ids) for word, ids in new.items() if word not in passing)
        return [known[words[0]] if len(words) == 1 else b"".join(map(known.__getitem__, words)) for words in spelt]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text, its ids as little-endian unsigned 32-bit integers, and
        the bytes that they decode to.

        A space between two characters that are no blanks begins a word. Texts
        are cut there, and each chunk is encoded once. Where no
        blank is next to another these are all spaces, which is tried first.
        """
        if len(self.ids) > CACHED_CHUNKS:
            # Those met first are met often; half of the room is for others.
            self.ids = dict(islice(self.ids.items(), CACHED_CHUNKS // 2))
        cut = [text.split(" ") for text in texts]
        fresh: set[str] = set()
        for chunks in cut:
            fresh.update(filterfalse(self.ids.__contains__, chunks[1:]))
        self.learn(fresh)
        found = [self.looked_up(chunks[1:]) for chunks in cut]
        again = [n for n, chunks in enumerate(cut) if found[n] is None or chunks[0][-1:].isspace()]
        ends = [""] * len(texts)
        for n in again:
            cut[n] = CUT.split(texts[n])
            if len(cut[n]) > 1:
                ends[n] = " " + cut[n].pop()
        self.learn({chunk for n in again for chunk in cut[n][1:]} - self.ids.keys())
        for n in again:
            found[n] = self.looked_up(cut[n][1:])
        # Heads follow no space, and ends may have blanks after them.
        outer = self.joined([self.split(t) for t in (*(c[0] for c in cut), *ends)])
        parts = zip(outer[: len(texts)], found, outer[len(texts) :], strict=True)
        encoded = list(map(b"".join, parts))
        return list(zip(encoded, self.decode(encoded), strict=True))

    def looked_up(self, chunks: list[str]) -> bytes | None:
        """Ids of known chunks, or None if one depends on its neighbours."""
        try:
            return b"".join(map(self.ids.__getitem__, chunks))
        except TypeError:  # of a chunk kept as None
            return None

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids, so many tokens at a time."""
        decoded: list[list[bytes]] = [[] for _ in encoded]
        pending: list[tuple[int, bytes]] = []
        size = 0
        for n, ids in enumerate(encoded):
            for start in range(0, len(ids), 4 * DECODE_TOKENS):
                part = ids[start : start + 4 * DECODE_TOKENS]
                if size + len(part) > 4 * DECODE_TOKENS:
                    self.decode_parts(pending, decoded)
                    pending, size = [], 0
                pending.append((n, part))
                size += len(part)
        self.decode_parts(pending, decoded)
        return list(map(b"".join, decoded))

    def decode_parts(self, parts: list[tuple[int, bytes]], decoded: list[list[bytes]]) -> None:
        if not parts:
            return
        tokens = np.frombuffer(b"".join(part for _, part in parts), "<u4")
        sizes = self.size[tokens]
        ends = np.cumsum(sizes)
        # Byte n of all parts is in the vocabulary as far from a token's start
        # there as it is from the token's start here.
        places = np.repeat(self.start[tokens] - (ends - sizes), sizes) + np.arange(ends[-1])
        found = self.pieces[places].tobytes()
        start = 0
        for (n, _), end in zip(parts, ends[np.cumsum([len(part) // 4 for _, part in parts]) - 1].tolist(), strict=True):
            decoded[n].append(found[start:end])
            start = end


# A space that begins a word whatever is around. Python's blanks include all of
# the pattern's.
CUT = re.compile(r"(?<=\S) (?=\S)")

# One codec for each Python worker and vocabulary; workers outlive tasks.
CODECS: dict[tuple[str, str], Codec] = {}


def codec_of(ranks: dict[bytes, int], name: str, pattern: str) -> Codec:
    if (name, pattern) not in CODECS:
        CODECS[name, pattern] = Codec(ranks, pattern)
    return CODECS[name, pattern]


def groups(texts: Iterable[str]) -> Iterator[list[str]]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= GROUP_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


def taken(column: pa.Array) -> Iterator[str]:
    """The texts of a column, a few rows in Python's memory at a time."""
    for start in range(0, len(column), TAKEN_ROWS):
        for text in column.slice(start, TAKEN_ROWS).to_pylist():
            yield text or ""


def token_digests(spark: SparkSession, docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per row: doc_id, number of ids, digest of the ids, digest of the decoded bytes.

    `vocabulary` is the path of a rank file on the driver, which sends it to
    the tasks once for each executor: the file's size bounds that.
    """
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks.value, vocabulary, pattern)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for texts in groups(taken(batch.column(1))):
                for ids, back in codec.encode(texts):
                    counts.append(len(ids) // 4)
                    digests.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(encode_batches, RESULT)
