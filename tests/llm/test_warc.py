from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ontime.llm import warc

FIELDS = "url string, payload string, file string, offset string, part string"


def placed(spark, rows, partitions=3):
    records = spark.createDataFrame([(u, p, "x", "y", "z") for u, p in rows], FIELDS).repartition(partitions)
    record = warc.warc_record(F.col("url"), F.col("payload"))
    digests = records.select("url", "payload", F.octet_length(record).cast("long").alias("n"), F.sha2(record, 256).alias("digest"))
    return warc.packed(spark, digests, "n")


def replicas(table, spoilt, lost, added=()):
    second = F.when(F.col("url").isin(*spoilt), F.lit("bad")).when(~F.col("url").isin(*lost) | F.col("url").isNull(), F.col("digest"))
    first = F.when(~F.col("url").isin(*added) | F.col("url").isNull(), F.col("digest"))
    return table.select("url", "file", "offset", F.posexplode(F.array(first, second)).alias("replica", "digest")).where("digest IS NOT NULL")


def test_offsets_are_those_of_the_files(spark):
    rows = [(f"u{i}", "é" * (i % 50)) for i in range(1500)] + [(None, None)] * 20 + [("same", "p")] * 300
    table = placed(spark, rows)
    files: dict = {}
    for r in table.collect():
        files.setdefault(r.file, []).append((r.offset, r.n))
    assert sum(map(len, files.values())) == len(rows)
    assert max(map(len, files.values())) <= warc.RECORDS_PER_FILE
    for records in files.values():
        at = 0
        for offset, size in sorted(records):
            assert offset == at
            at += size
    assert table.where("url IS NULL").first().n == len(warc_bytes("", ""))


def warc_bytes(url, body):
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: {url}\r\nContent-Type: text/html\r\n"
    return f"{head}Content-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n".encode()


def test_digest_is_that_of_the_record(spark):
    (row,) = placed(spark, [("http://a/", "é" * 100_000)]).collect()
    assert row.digest == hashlib.sha256(warc_bytes("http://a/", "é" * 100_000)).hexdigest()


def test_differences_are_located(spark):
    rows = [(f"u{i}", "x" * (i % 700)) for i in range(3000)]
    table = placed(spark, rows, 4)
    spoilt, lost, added = [f"u{i}" for i in range(5, 3000, 900)], ["u7", "u8"], ["u9"]
    records = replicas(table, spoilt, lost, added)
    found = warc.audit(spark, records)
    named = found.join(table, ["file", "offset"])
    assert {r.url: r.status for r in named.collect()} == (
        dict.fromkeys(spoilt, "corrupt") | dict.fromkeys(lost, "missing") | {"u9": "extra"}
    )


def test_equal_replicas_differ_nowhere(spark):
    table = placed(spark, [("u", "p")] * 500)
    records = replicas(table, ["none"], ["none"], ["none"])
    levels = warc.merkle_levels(spark, records)
    assert levels[-1][1].count() == 2
    assert warc.audit(spark, records).collect() == []


def test_descent_reads_few_leaves(spark):
    table = placed(spark, [(f"u{i}", "x" * 3000) for i in range(2000)])
    records = replicas(table, ["u77"], ["none"], ["none"])
    levels = warc.merkle_levels(spark, records)
    assert levels[0][1].count() > 400
    assert warc.differing_ranges(levels).count() == 1


def test_empty_store(spark):
    table = placed(spark, [("u", "p")])
    assert warc.audit(spark, replicas(table, ["u"], ["u"]).where("false")).collect() == []
