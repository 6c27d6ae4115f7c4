import datetime as dt

import pytest

from civicledger.operators import quality as Q


def test_checks(spark):
    child = spark.createDataFrame([("t1", "m1", None), ("t1", "m2", "x"), ("t3", None, "y"),
                                   ("t4", "m9", "z")], "tid string, mid string, v string")
    parent = spark.createDataFrame([("m1",), ("m2",)], "mid string")
    nn = {r.column_name: r.failures for r in Q.check_not_null(child, "c", ["tid", "mid", "v"]).collect()}
    assert nn == {"tid": 0, "mid": 1, "v": 1}
    assert Q.check_unique(child, "c", "tid").first().failures == 1
    assert Q.check_unique_combo(child, "c", ["tid", "mid"]).first().failures == 0
    assert Q.check_relationships(child, parent, "c", "mid", "mid").first().failures == 1


def test_gate_raises_and_passes(spark):
    specs = [Q.ModelTests("trades", not_null=["mid"], unique=["tid"],
                          relationships=[("mid", "officials", "mid")]),
             Q.ModelTests("officials", unique=["mid"])]
    trades = spark.createDataFrame([("t1", "m1"), ("t2", "m_missing")], "tid string, mid string")
    officials = spark.createDataFrame([("m1",)], "mid string")
    rep = Q.run_tests({"trades": trades, "officials": officials}, specs)
    with pytest.raises(Q.AuditFailed) as e:
        Q.gate(rep)
    assert [f["test_name"] for f in e.value.failures] == ["relationships"]
    good = Q.run_tests({"trades": trades.where("mid = 'm1'"), "officials": officials}, specs)
    assert len(Q.gate(good)) == 4


def test_source_freshness(spark):
    def t(ts):
        return spark.createDataFrame([(ts,)], "loaded timestamp_ntz")
    out = {r.table_name: r.status for r in Q.source_freshness({
        "fresh": (t(dt.datetime(2024, 1, 31)), "loaded"),
        "warn": (t(dt.datetime(2024, 1, 30, 6)), "loaded"),
        "stale": (t(dt.datetime(2024, 1, 28)), "loaded"),
        "empty": (t(None), "loaded"),
    }, "2024-01-31 12:00:00").collect()}
    assert out == {"fresh": "pass", "warn": "warn", "stale": "error", "empty": "error"}


def test_unique_against_new_rows_equals_full_check(spark):
    table = spark.createDataFrame([("r1",), ("r2",), ("r3",), ("r3",), (None,), (None,)], "rid string")
    new = spark.createDataFrame([("r3",), ("r9",), (None,)], "rid string")
    assert Q.check_unique_against(table, new, "m", "rid").first().failures == 1
    assert Q.check_unique(table, "m", "rid").first().failures == 1
    ok = spark.createDataFrame([("r2",)], "rid string")
    assert Q.check_unique_against(table.where("rid != 'r3' or rid is null"), ok, "m", "rid").first().failures == 0


def test_fused_not_null_and_unique_equals_separate_checks(spark):
    df = spark.createDataFrame([("t1", None, 1), ("t1", "x", None), ("t2", "y", 3), (None, None, 4),
                                (None, "z", 5)], "k string, a string, b int")
    fused = {(r.test_name, r.column_name): r.failures
             for r in Q.check_not_null_and_unique(df, "m", ["k", "a", "b"], "k").collect()}
    separate = {(r.test_name, r.column_name): r.failures
                for r in Q.check_not_null(df, "m", ["k", "a", "b"]).unionByName(
                    Q.check_unique(df, "m", "k")).collect()}
    assert fused == separate == {("not_null", "k"): 2, ("not_null", "a"): 2, ("not_null", "b"): 1,
                                 ("unique", "k"): 1}
    empty = Q.check_not_null_and_unique(df.limit(0), "m", ["a"], "k").collect()
    assert sorted(r.failures for r in empty) == [0, 0]
