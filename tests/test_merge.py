import datetime as dt

import pytest

from civicledger.operators import merge

T0 = dt.datetime(2024, 1, 1)
OLD_LOAD = dt.datetime(2024, 6, 1)
NEW_LOAD = dt.datetime(2024, 7, 1)
SCHEMA = "ticker string, name string, last_updated_utc timestamp_ntz, row_hash string, watermark_timestamp timestamp_ntz"


def test_mirror_sync_cases(spark):
    target = spark.createDataFrame([
        ("SAME", "Same Co", T0, "h1", OLD_LOAD),
        ("CHG", "Old Name", T0, "h2", OLD_LOAD),
        ("GONE", "Gone Co", T0, "h3", OLD_LOAD),
        ("NULLH", "Null Hash", T0, None, OLD_LOAD),
        (None, "No Key", T0, "h4", OLD_LOAD),
    ], SCHEMA)
    staging = spark.createDataFrame([
        ("SAME", "Same Co", T0, "h1", NEW_LOAD),
        ("CHG", "New Name", T0, "h2b", NEW_LOAD),
        ("CHG", "Older Name", T0 - dt.timedelta(days=1), "h2c", NEW_LOAD),   # older staged row ignored
        ("NEW", "New Co", T0, "h5", NEW_LOAD),
        ("NULLH", "Changed?", T0, "h6", NEW_LOAD),
        (None, "Staged No Key", T0, "h7", NEW_LOAD),
    ], SCHEMA)
    out = {r.ticker: r for r in merge.mirror_sync(target, staging, "ticker", "row_hash",
                                                  "last_updated_utc").collect()}
    assert set(out) == {"SAME", "CHG", "NEW", "NULLH"}            # keys == staged keys, no NULL
    assert out["SAME"].watermark_timestamp == OLD_LOAD            # unchanged keeps old load time
    assert out["CHG"].name == "New Name" and out["CHG"].watermark_timestamp == NEW_LOAD
    assert out["NEW"].name == "New Co"
    assert out["NULLH"].name == "Null Hash"                       # NULL hash never updates
    deleted = sorted((r.ticker for r in merge.mirror_deleted_keys(target, staging, "ticker").collect()),
                     key=str)
    assert deleted == ["GONE", None] or deleted == [None, "GONE"] or set(deleted) == {"GONE", None}


def test_upsert_replaces_and_inserts_never_deletes(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k string, v int")
    out = sorted(map(tuple, merge.upsert(target, source, "k").collect()), key=str)
    assert sorted(out, key=str) == sorted([("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)], key=str)


def test_upsert_composite_key(spark):
    target = spark.createDataFrame([("2024-01-01", "A", 1.0), ("2024-01-01", "B", 2.0)], "d string, t string, p double")
    source = spark.createDataFrame([("2024-01-01", "A", 1.5), ("2024-01-02", "A", 3.0)], "d string, t string, p double")
    out = sorted(map(tuple, merge.upsert(target, source, ["d", "t"]).collect()))
    assert out == [("2024-01-01", "A", 1.5), ("2024-01-01", "B", 2.0), ("2024-01-02", "A", 3.0)]


def test_duplicate_source_keys_fail(spark):
    source = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), (None, 4)], "k string, v int")
    with pytest.raises(merge.DuplicateKeyError):
        merge.assert_unique_keys(source, "k")
    merge.assert_unique_keys(source.where("v < 2 or v > 2"), "k")     # NULL keys are not duplicates


def test_affected_partitions(spark):
    target = spark.createDataFrame([("2024-01-01", "t1"), ("2024-02-01", "t2"), ("2024-03-01", "t3")],
                                   "report_date string, transaction_id string")
    source = spark.createDataFrame([("t2",), ("t9",)], "transaction_id string")
    parts = [r[0] for r in merge.affected_partitions(target, source, "transaction_id", "report_date").collect()]
    assert parts == ["2024-02-01"]
