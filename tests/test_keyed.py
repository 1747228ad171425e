from __future__ import annotations

import pytest
from flight_records import records

from ontime.sinks import keyed_replace, keyed_upsert, read_keyed, write_keyed_connector
from ontime.sinks.keyed import one_per_key


def batch(spark, *rows):
    return spark.createDataFrame(rows, "key string, a int, b string")


def contents(spark, root, table="t"):
    rows = records(read_keyed(spark, root, table))
    assert len(rows) == len({r["key"] for r in rows})
    return {r["key"]: (r["a"], r["b"]) for r in rows}


def files(root, table="t"):
    """Names and times of a table's data files, by bucket."""
    found = {}
    for path in (root / table).glob("*/*/*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return found


def test_upsert_overwrites_known_keys_and_keeps_others(spark, tmp_path):
    root = str(tmp_path)
    assert read_keyed(spark, root, "t") is None
    keyed_upsert(batch(spark, ("x", 1, "old"), ("y", 2, "old")), root, "t")
    keyed_upsert(batch(spark, ("y", 3, None), ("z", 4, "new")), root, "t")
    assert contents(spark, root) == {"t:x": (1, "old"), "t:y": (3, None), "t:z": (4, "new")}


def test_replace_drops_old_keys_of_its_table_only(spark, tmp_path):
    root = str(tmp_path)
    keyed_upsert(batch(spark, ("x", 1, "")), root, "t")
    keyed_upsert(batch(spark, ("x", 9, "")), root, "other")
    keyed_replace(batch(spark, ("y", 2, "")), root, "t")
    assert contents(spark, root) == {"t:y": (2, "")}
    assert contents(spark, root, "other") == {"other:x": (9, "")}


def test_duplicate_keys_in_a_batch(spark, tmp_path):
    rows = [("x", 3, "a"), ("x", 2, "c"), ("x", 1, "b"), ("y", None, "c")]
    root = str(tmp_path)
    with pytest.raises(Exception, match="records that differ for key"):
        keyed_upsert(batch(spark, *rows), root, "t")
    assert read_keyed(spark, root, "t") is None
    keyed_upsert(batch(spark, *rows), root, "t", order_by="b")
    assert contents(spark, root) == {"t:x": (2, "c"), "t:y": (None, "c")}
    keyed_upsert(batch(spark, ("x", 7, "d"), ("x", 7, "d")), root, "t")
    assert contents(spark, root)["t:x"] == (7, "d")


def test_an_upsert_leaves_files_of_other_buckets(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"k{n}", n, "old") for n in range(400)]
    keyed_upsert(batch(spark, *rows), root, "t", buckets=32)
    before = files(tmp_path)
    assert len(before) == 32
    keyed_upsert(batch(spark, ("k7", -1, "new"), ("fresh", -2, "new")), root, "t")
    after = files(tmp_path)
    changed = {bucket for bucket in before if before[bucket] != after[bucket]}
    assert before.keys() == after.keys() and 1 <= len(changed) <= 2
    assert contents(spark, root) == {f"t:{k}": (a, b) for k, a, b in rows} | {
        "t:k7": (-1, "new"),
        "t:fresh": (-2, "new"),
    }


def test_an_upsert_does_not_read_other_buckets(spark, tmp_path):
    root = str(tmp_path)
    keyed_upsert(batch(spark, *[(f"k{n}", n, "") for n in range(200)]), root, "t")
    for bucket in (tmp_path / "t").glob("*/*"):
        if "t:k3" not in {r["key"] for r in records(spark.read.parquet(str(bucket)))}:
            for data in bucket.glob("*.parquet"):
                data.write_bytes(b"not a Parquet file")
    keyed_upsert(batch(spark, ("k3", -3, "new")), root, "t")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        read_keyed(spark, root, "t").count()


def test_a_batch_is_computed_once(spark, tmp_path):
    root = str(tmp_path)
    keyed_upsert(batch(spark, ("x", 1, "a"), ("y", 2, "b")), root, "t")
    made = spark.range(2).selectExpr("concat('n', id) AS key", "cast(rand() * 1e9 AS int) AS a", "'new' AS b")
    keyed_upsert(made, root, "t")
    assert set(contents(spark, root)) == {"t:x", "t:y", "t:n0", "t:n1"}


def test_a_table_keeps_its_number_of_buckets_until_replaced(spark, tmp_path):
    root = str(tmp_path)
    rows = [(str(n), n, "") for n in range(50)]
    keyed_upsert(batch(spark, *rows), root, "t", buckets=4)
    keyed_upsert(batch(spark, *rows), root, "t", buckets=9)
    assert len(files(tmp_path)) == 4 and len(contents(spark, root)) == 50
    keyed_replace(batch(spark, *rows), root, "t", buckets=9)
    assert len(files(tmp_path)) == 9 and len(contents(spark, root)) == 50


def test_empty_batches(spark, tmp_path):
    root = str(tmp_path)
    keyed_replace(batch(spark), root, "t")
    assert read_keyed(spark, root, "t").columns == ["key", "a", "b"]
    assert contents(spark, root) == {}
    keyed_upsert(batch(spark, ("x", 1, "a")), root, "t")
    keyed_upsert(batch(spark), root, "t")
    assert contents(spark, root) == {"t:x": (1, "a")}
    keyed_replace(batch(spark), root, "t")
    assert contents(spark, root) == {}


def test_a_failed_upsert_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    keyed_upsert(batch(spark, *[(str(n), n, "") for n in range(40)]), root, "t")
    before = files(tmp_path)
    broken = spark.range(40).selectExpr(
        "string(id) AS key", "int(if(id = 39, raise_error('lost'), id)) AS a", "'' AS b"
    )
    with pytest.raises(Exception, match="lost"):
        keyed_upsert(broken, root, "t")
    assert files(tmp_path) == before and len(contents(spark, root)) == 40


def test_records_without_fields(spark):
    df = spark.createDataFrame([("x",), ("x",)], "key string")
    assert one_per_key(df).count() == 1


def test_new_fields_of_a_later_batch(spark, tmp_path):
    root = str(tmp_path)
    keyed_upsert(batch(spark, ("x", 1, "a")).drop("b"), root, "t")
    keyed_upsert(batch(spark, ("y", 2, "b")), root, "t")
    assert contents(spark, root) == {"t:x": (1, None), "t:y": (2, "b")}


def test_null_key_fails(spark, tmp_path):
    with pytest.raises(Exception, match="null part"):
        keyed_upsert(batch(spark, (None, 1, "a")), str(tmp_path), "t")
    assert read_keyed(spark, str(tmp_path), "t") is None


def test_connector_sink_takes_any_format(spark, tmp_path):
    df = batch(spark, ("x", 1, "a"))
    path = str(tmp_path / "out")
    write_keyed_connector(df, "t", "json", options={"path": path})
    write_keyed_connector(df, "t", "json", mode="append", options={"path": path})
    assert spark.read.json(path).count() == 2
    with pytest.raises(ValueError, match="missing columns"):
        write_keyed_connector(df.drop("key"), "t", "json", options={"path": path})
