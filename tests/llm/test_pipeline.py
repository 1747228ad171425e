from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter

import helpers
import plain_pii
import public_tokenizers
import tiktoken

import corpus_pipeline
from ontime.llm import bpe, pii

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, hash string, kept string"


def quality(docs):
    """doc -> text left, for documents that pass; all in plain Python."""
    by_host: dict = {}
    for _, text, source in docs:
        by_host.setdefault(source, set()).add(text)
    norm = lambda line: " ".join(helpers.words(line)).lower()
    frequent = {}
    for source, texts in by_host.items():
        seen = Counter(n for t in texts for n in {norm(x) for x in (t or "").split("\n")} if n)
        frequent[source] = {n for n, c in seen.items() if c >= 10 and 100 * c > 10 * len(texts)}
    kept = []
    for doc_id, text, source in docs:
        tokens = helpers.words(text)
        if len(tokens) < 10 or 100 * helpers.repeat_words(tokens) > 20 * len(tokens):
            continue
        left = "\n".join(x for x in text.split("\n") if norm(x) not in frequent[source])
        n = len(helpers.words(left))
        if 100 * n >= 20 * len(tokens):
            kept.append((doc_id, left, source))
    return kept


def mixed(docs):
    """Copies of each document, by sorting hashes."""
    sizes: dict = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(helpers.words(text))
    result = []
    for source, target in helpers.targets(sizes).items():
        rows = sorted(
            (int(hashlib.md5(f"{k}:{t}".encode()).hexdigest()[:15], 16), len(helpers.words(t)), k, t)
            for k, t, s in docs
            if s == source
        )
        whole = min(3, int(target / sizes[source])) if sizes[source] else 0
        budget, before = target - whole * sizes[source], 0
        for _, size, k, text in rows:
            extra = whole < 3 and before < budget and (before + size <= budget or before + size - budget <= budget - before)
            before += size
            result += [(k, text)] * (whole + extra)
    return result


def test_stages_are_as_dealt():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "privacy", "source mix", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_against_plain_python(spark, small_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    kept = quality(docs)
    groups = helpers.groups({k: t for k, t, _ in kept}, 5)
    once = [(k, t, s) for k, t, s in kept if groups[k] == k]
    private = [
        (k, plain_pii.pseudonymised(t, corpus_pipeline.PSEUDONYM_KEY, pii.PATTERN)[0], s) for k, t, s in once
    ]
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    expected = Counter()
    for k, text in mixed(private):
        ids = library.encode_ordinary(text)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected[k, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    found = Counter(map(tuple, corpus_pipeline.run(spark, small_dir).collect()))
    assert found == expected


def test_every_stage_takes_awkward_rows(spark, small_dir):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [
        (1, None, None, None, None, None, None),
        (None, "ten words of text that are long enough to stay here", "en", None, 1, "x", "y"),
        (2, "", "en", "s", 0, "x", "y"),
        (3, long, "en", "s", 1, "x", "y"),
        (3, long, "en", "s", 1, "x", "y"),
        (4, "mail joe.10@mail1.example.com to the ten people who asked for it today please", "en", "s", 1, "x", "y"),
    ]
    docs = spark.createDataFrame(rows, FIELDS)
    for frame in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, frame, small_dir)
            result.write.mode("overwrite").format("noop").save()
            if name != "tokens":
                assert result.columns == docs.columns, name


def test_no_personal_data_comes_out(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in corpus_pipeline.privacy_stage(spark, docs, small_dir).collect()}
    private = re.compile(r"[\w.]+@[\w.]+\.com|\d+\.\d+\.\d+\.\d+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b")
    assert before.keys() == after.keys()
    for k, text in before.items():
        values = {v for v in private.findall(text) if len(v) != 16 or not v.isdigit() or helpers.luhn(v)}
        assert not values & set(private.findall(after[k]))
        if not values and not re.search(r"AKIA|token|password", text):
            assert after[k] == text
