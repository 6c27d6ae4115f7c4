import datetime as dt

import pytest
from pyspark.sql import functions as F

from civicledger.operators import scd2

D = dt.datetime
SRC = "member_id string, name string, updated timestamp_ntz"
RUN = D(2024, 3, 1)


def _snap(spark):
    v1 = spark.createDataFrame([("same", "A", D(2024, 1, 1)), ("newer", "B", D(2024, 1, 1)),
                                ("older", "C", D(2024, 1, 1)), ("gone", "D", D(2024, 1, 1))], SRC)
    return scd2.initial(v1, "member_id", "updated")


def test_scd2_cases(spark):
    snap = _snap(spark)
    v2 = spark.createDataFrame([("same", "A", D(2024, 1, 1)), ("newer", "B2", D(2024, 2, 1)),
                                ("older", "C0", D(2023, 12, 1)), ("fresh", "E", D(2024, 2, 15))], SRC)
    nxt = scd2.apply(snap, v2, "member_id", "updated", RUN)
    rows = {(r.member_id, r.dbt_valid_to is None): r for r in nxt.collect()}
    assert rows[("same", True)].name == "A"
    assert rows[("newer", False)].dbt_valid_to == D(2024, 2, 1)           # closed at the new version
    assert rows[("newer", True)].name == "B2" and rows[("newer", True)].dbt_valid_from == D(2024, 2, 1)
    assert rows[("older", True)].name == "C"                               # older update ignored
    assert rows[("gone", False)].dbt_valid_to == RUN                       # hard delete at run time
    assert rows[("fresh", True)].dbt_valid_from == D(2024, 2, 15)
    assert nxt.count() == 6
    # back again after the hard delete: a new open row
    v3 = v2.unionByName(spark.createDataFrame([("gone", "D", D(2024, 3, 5))], SRC))
    nxt2 = scd2.apply(nxt, v3, "member_id", "updated", D(2024, 4, 1))
    gone = nxt2.where("member_id = 'gone'").orderBy("dbt_valid_from").collect()
    assert [g.dbt_valid_to is None for g in gone] == [False, True]
    _check_invariants(nxt2)


def _check_invariants(snap):
    open_per_key = snap.groupBy("member_id").agg(F.count_if(F.col("dbt_valid_to").isNull()).alias("n"))
    assert open_per_key.where("n > 1").count() == 0
    rows = sorted(snap.collect(), key=lambda r: (r.member_id, r.dbt_valid_from))
    for a, b in zip(rows, rows[1:]):
        if a.member_id == b.member_id:
            assert a.dbt_valid_to is not None and a.dbt_valid_to <= b.dbt_valid_from


def test_scd2_is_idempotent(spark):
    snap = _snap(spark)
    v = spark.createDataFrame([("same", "A", D(2024, 1, 1)), ("newer", "B", D(2024, 1, 1)),
                               ("older", "C", D(2024, 1, 1)), ("gone", "D", D(2024, 1, 1))], SRC)
    again = scd2.apply(snap, v, "member_id", "updated", RUN)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, snap.collect()))
    assert scd2.hard_deleted(snap, v, "member_id").count() == 0
    assert scd2.current(again).count() == 4


def test_partitioned_snapshot_equals_whole_table_apply(spark, tmpdir_):
    """Open/closed partition layout (daily runs) == applying SCD2 to the whole table."""
    from civicledger.plans import daily
    wh = daily.Warehouse(spark, f"{tmpdir_}/w", f"{tmpdir_}/l")
    versions = [
        [("a", "A", D(2024, 1, 1)), ("b", "B", D(2024, 1, 1)), ("c", "C", D(2024, 1, 1))],
        [("a", "A2", D(2024, 2, 1)), ("b", "B", D(2024, 1, 1)), ("d", "D", D(2024, 2, 1))],
        [("a", "A3", D(2024, 3, 1)), ("c", "C", D(2024, 3, 1)), ("d", "D", D(2024, 2, 1))],
    ]
    runs = ["2024-02-01 00:00:00", "2024-02-15 00:00:00", "2024-03-15 00:00:00"]
    whole = None
    for rows, run in zip(versions, runs):
        src = spark.createDataFrame(rows, SRC)
        daily._snapshot(wh, "dim_x", src, "member_id", "updated", run)
        daily._snapshot(wh, "dim_x", src, "member_id", "updated", run)     # re-run: no change
        whole = scd2.initial(src, "member_id", "updated") if whole is None else \
            scd2.apply(whole, src, "member_id", "updated", D.fromisoformat(run))
        whole = spark.createDataFrame(whole.collect(), whole.schema)         # materialise the step
    got = sorted(map(tuple, daily.dimension(wh, "dim_x").select(*whole.columns).collect()), key=str)
    assert got == sorted(map(tuple, whole.collect()), key=str)
    stored = daily.dimension_table(wh, "dim_x").read()
    parts = {r[0] for r in stored.select(daily.CLOSED_IN_RUN).distinct().collect()}
    assert parts == {None, dt.date(2024, 2, 15), dt.date(2024, 3, 15)}


def test_partitioned_snapshot_recovers_from_a_run_that_died(spark, tmpdir_, monkeypatch):
    """Stopped before the publish, or repeated past midnight: every key is closed once."""
    from civicledger.plans import daily
    from civicledger.sources.store import PartitionedTable
    wh = daily.Warehouse(spark, f"{tmpdir_}/w", f"{tmpdir_}/l")
    v1 = spark.createDataFrame([("a", "A", D(2024, 1, 1)), ("b", "B", D(2024, 1, 1))], SRC)
    v2 = spark.createDataFrame([("a", "A2", D(2024, 2, 1))], SRC)
    daily._snapshot(wh, "dim_y", v1, "member_id", "updated", "2024-01-15 00:00:00")
    with monkeypatch.context() as m:
        m.setattr(PartitionedTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            daily._snapshot(wh, "dim_y", v2, "member_id", "updated", "2024-02-29 22:30:00")
    for run in ("2024-02-29 23:59:00", "2024-03-01 01:29:00"):                 # the re-run, and one more
        daily._snapshot(wh, "dim_y", v2, "member_id", "updated", run)
    clean = scd2.apply(scd2.initial(v1, "member_id", "updated"), v2, "member_id", "updated", D(2024, 2, 29, 23, 59))
    got = sorted(map(tuple, daily.dimension(wh, "dim_y").select(*clean.columns).collect()), key=str)
    assert got == sorted(map(tuple, clean.collect()), key=str)
