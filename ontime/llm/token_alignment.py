"""Alignment of two tokenizers' tokens, and how often each linked pair of ids occurs.

Both tokenizers spell the same bytes, a space and the text. A token ends at a
byte offset; dictionaries from end to index for either side are intersected,
and the common ends in order slice both id lists into groups. Inside a group
each token is linked with every token of the other side that shares a byte
with it.

Tokens never reach over a space that stands between two other characters: the
byte-level vocabulary's pattern begins a word there, and no piece of the other
vocabulary has a space behind another character (which is checked). Both sides
end a token before such a space, so texts are cut there and each chunk between
two cuts is encoded and aligned once and kept in a bounded cache; a text's
groups are those of its chunks in order.

Documents are taken in blocks of a bounded number of links. A block lists its
distinct pairs once, each with the number of its documents that hold it, and
its documents point into that list. Only lists are shuffled, added up per pair
and compared per left id (which has no more partners than the other vocabulary
has ids); each block gets back the counts of its own pairs and weighs its
documents with them. No task sees more than a block, or the list of one left
id, and nothing is broadcast or collected.

Defined results: texts that are null, empty, or that a tokenizer does not spell
byte by byte (say with U+2581 in them) have no tokens and no groups, and count
for no pair; each row is a document of its own, whatever its key, which may be
null; an empty table gives an empty result; texts are taken whole, a very long
one makes a block of its own; other columns do not matter.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Mapping
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.llm.common import materialise

# Distinct links of documents that a block holds before it is closed; some 40
# bytes each in memory.
BLOCK_LINKS = 1_000_000
# Chunks that a Python worker keeps, some 400 bytes each, and learns at once.
CACHED_CHUNKS = 250_000
LEARNT_CHUNKS = 20_000

SPACE = "▁"
# Marks that may end a chunk.
MARKS = ".,;:!?"
# The spaces to cut at.
CUT = re.compile(r"(?<=\S) (?=\S)")

ALIGNED = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("key", T.LongType()),
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups", T.StringType()),
        # Of a document: places in its block's list, and how often it has the pair.
        T.StructField("places", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.IntegerType())),
        # Of a block (one more row): its distinct pairs, and how many documents have them.
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("documents", T.ArrayType(T.LongType())),
    ]
)


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the other bytes in
    order for the characters from 256 on.
    """
    plain = {b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def byte_level_pieces(path: str) -> dict[int, bytes]:
    """Token bytes of a byte-level vocabulary file, by id."""
    alphabet = byte_level_alphabet()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    return {number: bytes(map(alphabet.__getitem__, token)) for token, number in vocabulary.items()}


def spelt(ids: np.ndarray, starts: np.ndarray, pieces: list[bytes], chunks: list[bytes]) -> np.ndarray:
    """For each chunk whether its tokens' bytes are its own."""
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    token_bytes = [pieces[n] for n in ids.tolist()]
    upto = np.append(0, np.cumsum(np.fromiter(map(len, token_bytes), np.int64, len(ids))))
    right = upto[starts[1:]] - upto[starts[:-1]] == sizes
    if right.all() and b"".join(token_bytes) == b"".join(chunks):
        return right
    bounds = zip(starts[:-1].tolist(), starts[1:].tolist(), chunks, strict=True)
    return np.array([b"".join(token_bytes[i:j]) == chunk for i, j, chunk in bounds])


def slice_ends(ends: np.ndarray, other_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ends that both sides have, in order, and the tokens of either side up to each."""
    index = dict(zip(ends.tolist(), range(1, len(ends) + 1), strict=True))
    other_index = dict(zip(other_ends.tolist(), range(1, len(other_ends) + 1), strict=True))
    common = sorted(index.keys() & other_index.keys())
    return (
        np.array(common, np.int64),
        np.fromiter(map(index.__getitem__, common), np.int64, len(common)),
        np.fromiter(map(other_index.__getitem__, common), np.int64, len(common)),
    )


def slice_links(ends: np.ndarray, other_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that share a byte, in order: the end of the shared bytes, and both indexes.

    Between two neighbouring ends of either side lie bytes of one token of
    each; within a slice each such stretch is a link, and no link has two.
    """
    both = np.concatenate([ends, other_ends])
    both.sort(kind="stable")
    stretches = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
    return stretches, np.searchsorted(ends, stretches), np.searchsorted(other_ends, stretches)


def id_lists(ids: np.ndarray, upto: np.ndarray) -> pa.Array:
    """Slices of ids, each as text with commas."""
    listed = pa.ListArray.from_arrays(
        pa.array(np.append(0, upto), pa.int32()), pa.array(ids, pa.int32()).cast(pa.string())
    )
    return pc.binary_join(listed, ",")


def odd_edges(chunk: str) -> bool:
    """Whether a chunk is empty, or begins or ends with a blank."""
    return not chunk or chunk[0].isspace() or chunk[-1].isspace()


ODD = -1


class Places(dict):
    """Numbers of chunks in order of appearance, and those that are new.

    A chunk with odd edges has none, since it depends on its neighbours, unless
    a text was cut with care: it then stands in a tuple.
    """

    def __init__(self, known: Iterable[str | tuple[str]] = ()):
        super().__init__((chunk, at) for at, chunk in enumerate(known))
        self.count = len(self)
        self.fresh: list[str | tuple[str]] = []

    def __missing__(self, chunk: str | tuple[str]) -> int:
        if type(chunk) is str and odd_edges(chunk):
            self[chunk] = ODD
            return ODD
        self[chunk] = place = self.count
        self.count += 1
        self.fresh.append(chunk)
        return place


class Aligner:
    """Two tokenizers and the chunks aligned so far."""

    def __init__(self, left_path: str, right_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.left = Tokenizer.from_file(left_path)
        self.left.encode_special_tokens = True
        pieces = byte_level_pieces(left_path)
        self.left_bytes = [pieces.get(n, b"") for n in range(max(pieces) + 1)]
        self.right = sentencepiece.SentencePieceProcessor(model_file=right_path)
        pieces = [self.right.id_to_piece(n) for n in range(self.right.get_piece_size())]
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece has a space behind another character")
        self.right_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.right.is_byte(n) else piece.replace(SPACE, " ").encode()
            for n, piece in enumerate(pieces)
        ]
        self.left_sizes, self.right_sizes = (
            np.fromiter(map(len, known), np.int64, len(known)) for known in (self.left_bytes, self.right_bytes)
        )
        # Marks that no piece joins to a letter before them; the other
        # vocabulary's pattern never does. Each is a token of its own there.
        joined = {b for piece in pieces for a, b in pairwise(piece) if a.isalpha()}
        self.marks = {
            mark: (self.left.encode(mark, add_special_tokens=False).ids[0], self.right.piece_to_id(mark))
            for mark in MARKS
            if mark not in joined and self.right.piece_to_id(mark) != self.right.unk_id()
        }
        # Each chunk has a place; lists hold its groups and pairs, an array its
        # numbers of left and right tokens and groups (none if it is not spelt).
        self.place = Places()
        self.groups: list[str | None] = []
        self.pairs: list[bytes | None] = []
        self.sizes = np.empty((0, 3), np.int64)
        self.uses = np.empty(0, np.int64)

    def forget(self) -> None:
        """Keep the chunks that were met twice or more since the last time."""
        kept = {chunk: at for chunk, at in self.place.items() if at >= 0 and self.uses[at] > 1}
        if len(kept) > CACHED_CHUNKS // 2:
            kept = {}
        places = list(kept.values())
        self.place = Places(kept)
        self.groups = [self.groups[at] for at in places]
        self.pairs = [self.pairs[at] for at in places]
        self.sizes = self.sizes[places]
        self.uses = np.zeros(len(kept), np.int64)

    def learn(self) -> None:
        """Align the chunks that have a place but no groups yet.

        Those that end with a mark behind a letter are what is before it, and
        the mark.
        """
        fresh = self.place.fresh
        marked = [c for c in fresh if type(c) is str and c[-1] in self.marks and c[-2:-1].isalpha()]
        before = [self.place[c[:-1]] for c in marked]
        more = self.place.count - len(self.groups)
        self.groups += [None] * more
        self.pairs += [None] * more
        self.sizes = np.concatenate([self.sizes, np.zeros((more, 3), np.int64)])
        self.uses = np.concatenate([self.uses, np.zeros(more, np.int64)])
        whole = set(fresh).difference(marked)
        odd = [c for c in whole if type(c) is tuple or SPACE in c]
        for some in (list(whole.difference(odd)), odd):
            for at in range(0, len(some), LEARNT_CHUNKS):
                self.learn_whole(some[at : at + LEARNT_CHUNKS])
        for chunk, at in zip(marked, before, strict=True):
            place = self.place[chunk]
            left, right = self.marks[chunk[-1]]
            self.groups[place] = f"{self.groups[at]};{left}|{right}"
            self.pairs[place] = self.pairs[at] + (left << 32 | right).to_bytes(8, "little")
        if marked:
            places = np.fromiter(map(self.place.__getitem__, marked), np.int64, len(marked))
            sizes = self.sizes[before]
            self.sizes[places] = sizes + (sizes[:, :1] > 0)
        fresh.clear()

    def learn_whole(self, keys: list[str | tuple[str]]) -> None:
        """Encode chunks and align them, all in one run of bytes.

        Chunks follow each other there, so each one's last byte is a common end.
        """
        chunks = [key if type(key) is str else key[0] for key in keys]
        spelling = [b" " + chunk.encode() for chunk in chunks]
        left, left_at, right, right_at = self.encoded(chunks, spelling)
        good = spelt(left, left_at, self.left_bytes, spelling)
        good &= spelt(right, right_at, self.right_bytes, spelling)
        left = left[np.repeat(good, np.diff(left_at))]
        right = right[np.repeat(good, np.diff(right_at))]
        ends, other_ends = np.cumsum(self.left_sizes[left]), np.cumsum(self.right_sizes[right])
        common, upto, other_upto = slice_ends(ends, other_ends)
        groups = pc.binary_join_element_wise(id_lists(left, upto), id_lists(right, other_upto), "|")
        stretches, i, j = slice_links(ends, other_ends)
        pairs = (left[i] << 32 | right[j]).astype("<i8").tobytes()

        # Where each chunk ends, in bytes, and with that in groups and in links.
        last = np.cumsum(np.where(good, np.fromiter(map(len, spelling), np.int64, len(chunks)), 0))
        group_at = np.append(0, np.searchsorted(common, last, "right"))
        link_at = np.append(0, np.searchsorted(stretches, last, "right")) * 8
        listed = pa.ListArray.from_arrays(pa.array(group_at, pa.int32()), groups)
        places = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))
        bounds = zip(places.tolist(), pc.binary_join(listed, ";").to_pylist(), link_at[:-1].tolist(), link_at[1:].tolist(), strict=True)
        for place, text, a, b in bounds:
            self.groups[place] = text
            self.pairs[place] = pairs[a:b]
        numbers = np.stack([np.diff(left_at), np.diff(right_at), np.diff(group_at)], axis=1)
        self.sizes[places] = np.where(good[:, None], numbers, 0)

    def encoded(self, chunks: list[str], spelling: list[bytes]) -> tuple[np.ndarray, ...]:
        """Ids of either side, and where those of each chunk start and the last ends.

        Chunks without a blank at either end are encoded as one text, which is
        cut at their ends. Should it not come out byte by byte, and for other
        chunks, each is encoded alone.
        """
        if not any(map(odd_edges, chunks)):
            whole = " ".join(chunks)
            left = np.array(self.left.encode(" " + whole, add_special_tokens=False).ids, np.int64)
            right = np.array(self.right.encode(whole), np.int64)
            last = np.cumsum(np.fromiter(map(len, spelling), np.int64, len(chunks)))
            at = [
                np.append(0, np.searchsorted(ends, last, "right"))
                for ends in (np.cumsum(self.left_sizes[left]), np.cumsum(self.right_sizes[right]))
            ]
            if b"".join(map(self.left_bytes.__getitem__, left.tolist())) == b"".join(
                map(self.right_bytes.__getitem__, right.tolist())
            ) == b"".join(spelling):
                return left, at[0], right, at[1]
        texts = [" " + chunk for chunk in chunks]
        single = [e.ids for e in self.left.encode_batch_fast(texts, add_special_tokens=False)]
        return *flat(single), *flat(self.right.encode(chunks, num_threads=1))

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """Per text: numbers of left and right tokens and of groups, groups, pairs of ids."""
        if self.place.count > CACHED_CHUNKS:
            self.forget()
        cut = [text.split(" ") if text else [] for text in texts]
        found = [list(map(self.place.__getitem__, chunks)) for chunks in cut]
        for n, places in enumerate(found):
            # A blank stands next to a space, so that this text is cut at fewer places.
            if ODD in places:
                found[n] = [self.place[(c,) if odd_edges(c) else c] for c in CUT.split(texts[n])]
        self.learn()
        for places in found:
            sizes = self.sizes[places]
            if not places or not sizes[:, 0].all():
                yield 0, 0, 0, "", np.empty(0, np.int64)
                continue
            np.add.at(self.uses, places, 1)
            groups = ";".join(map(self.groups.__getitem__, places))
            pairs = b"".join(map(self.pairs.__getitem__, places))
            yield *sizes.sum(axis=0).tolist(), groups, np.frombuffer(pairs, "<i8")


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids one after the other, and where each starts and the last ends."""
    starts = np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))))
    return np.fromiter(chain.from_iterable(ids), np.int64, starts[-1]), starts


class Block:
    """Documents whose pairs are listed together."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int | None, document: tuple[int, int, int, str, np.ndarray]) -> None:
        left, right, groups, text, pairs = document
        distinct, times = np.unique(pairs, return_counts=True)
        self.rows.append((key, left, right, groups, len(pairs), text))
        self.pairs.append(distinct)
        self.times.append(times)
        self.size += len(distinct) + 1

    def table(self, number: int) -> pa.RecordBatch:
        distinct, places, documents = np.unique(
            np.concatenate(self.pairs), return_inverse=True, return_counts=True
        )
        ends = np.append(0, np.cumsum([len(pairs) for pairs in self.pairs])).astype(np.int32)
        rows = len(self.rows)
        key, left, right, groups, n_links, text = zip(*self.rows, strict=True)
        listed = [None] * rows
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (rows + 1), pa.int64()),
                *(pa.array([*column, None], pa.int64()) for column in (key, left, right, groups, n_links)),
                pa.array([*text, None], pa.string()),
                *(
                    pa.concat_arrays([lists(flat, ends), pa.nulls(1, pa.list_(pa.int32()))])
                    for flat in (places, np.concatenate(self.times))
                ),
                pa.array([*listed, distinct], pa.list_(pa.int64())),
                pa.array([*listed, documents], pa.list_(pa.int64())),
            ],
            names=ALIGNED.names,
        )


def lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def alignments(
    documents: DataFrame, left_path: str, right_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document its tokens' groups and pairs, in blocks; and a row per block."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(left_path, right_path)
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            keys, texts = (column.to_pylist() for column in batch.columns)
            for some in some_texts(texts):
                for one, document in zip(keys[some], aligner.documents(texts[some]), strict=True):
                    block.add(one, document)
                    if block.size >= BLOCK_LINKS:
                        yield block.table(number)
                        number, block = number + 1, Block()
        if block.rows:
            yield block.table(number)

    chosen = documents.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"))
    return chosen.mapInArrow(align, ALIGNED)


def some_texts(texts: list[str | None], chars: int = 1_000_000) -> Iterator[slice]:
    """Slices of texts of about so many characters, one text at least."""
    start = size = 0
    for number, text in enumerate(texts):
        size += len(text or "")
        if size >= chars:
            yield slice(start, number + 1)
            start, size = number + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def pair_counts(written: DataFrame) -> DataFrame:
    """Per pair of ids: its number of documents, and whether no other pair of
    its left id has more."""
    counted = listed_pairs(written).groupBy("pair").agg(F.sum("n").alias("count"))
    left = Window.partitionBy(F.shiftright("pair", 32))
    return counted.withColumn("best", F.col("count") == F.max("count").over(left))


def listed_pairs(written: DataFrame) -> DataFrame:
    return (
        written.where(F.col("pairs").isNotNull())
        .select("block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("place", "one"))
        .select("block", "place", F.col("one.pairs").alias("pair"), F.col("one.documents").alias("n"))
    )


def weigh(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of a block's documents, from the counts of its pairs."""
    order = np.argsort(counts.column("place").to_numpy())
    count = counts.column("count").to_numpy()[order]
    best = counts.column("best").to_numpy()[order].astype(np.int64)
    documents = documents.combine_chunks()
    places, times = (documents.column(name).combine_chunks() for name in ("places", "times"))
    ends = np.append(0, np.cumsum(places.value_lengths().to_numpy()))
    place = places.flatten().to_numpy()
    often = times.flatten().to_numpy().astype(np.int64)
    kept = documents.drop_columns(["block", "places", "times"])
    for name, weight in (("n_best", best), ("count_sum", count)):
        upto = np.append(0, np.cumsum(weight[place] * often))
        kept = kept.append_column(name, pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64()))
    return kept


def aligned_documents(
    spark: SparkSession,
    documents: DataFrame,
    left_path: str,
    right_path: str,
    key: str = "doc_id",
    text: str = "text",
    outputs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, and `outputs`.

    By default these are the groups themselves, `a1,a2|b1;a3|b2,b3` in ids. A
    pair's count is the number of documents in which it is linked; `n_best`
    counts links whose pair no other one of the same left id exceeds,
    `count_sum` adds up the counts over the links.
    """
    outputs = outputs or {"groups": F.col("groups")}
    found = alignments(documents, left_path, right_path, key, text)
    drop = [c for c in ("groups",) if c not in outputs]
    written, _ = materialise(spark, found.withColumns(dict(outputs)).drop(*drop), "alignments")
    counts = listed_pairs(written).select("block", "place", "pair").join(pair_counts(written), "pair")
    numbers = ["key", "n_a", "n_b", "n_groups", "n_links"]
    rows = written.where(F.col("pairs").isNull()).select("block", "places", "times", *numbers, *outputs)
    schema = T.StructType(
        [
            *(rows.schema[name] for name in [*numbers, *outputs]),
            T.StructField("n_best", T.LongType()),
            T.StructField("count_sum", T.LongType()),
        ]
    )
    back = counts.select(F.col("block").alias("to"), "place", "count", "best")
    weighed = rows.groupBy("block").cogroup(back.groupBy("to"))
    return weighed.applyInArrow(weigh, schema).withColumnRenamed("key", key)
