"""Co-bucketed layout of published tables, and the fact read through it."""

import datetime as dt

import pytest

from civicledger.plans import daily
from civicledger.plans import models as M
from civicledger.sources import colocated as C
from civicledger.sources.store import PartitionedTable, PublishConflict, Snapshots
from fixtures import DAYS, land_day
from planutil import plan_text

DATES = [dt.date(2024, 6, 1) + dt.timedelta(days=i) for i in range(6)]
LEFT, RIGHT = "k string, day date, v int, d date", "key string, at date, price double"


def left_rows(n, shift=0):
    return [(f"k{i % 5}", DATES[i % 4], i + shift, DATES[i % 3]) for i in range(n)] + [(None, None, -1 - shift, None)]


@pytest.fixture()
def pair(spark, tmpdir_):
    left, right = PartitionedTable(spark, f"{tmpdir_}/left", "d", ["k"]), PartitionedTable(spark, f"{tmpdir_}/right", "at", ["key"])
    left.write(spark.createDataFrame(left_rows(40), LEFT), pack=True)
    right.write(spark.createDataFrame([(f"k{i}", d, float(i)) for i in range(4) for d in DATES[:3]], RIGHT))
    layout = C.Colocated(spark, f"{tmpdir_}/layout", {"left": left, "right": right},
                         {"left": ["day", "k"], "right": ["at", "key"]})
    return left, right, layout


def state(left, right):
    return {"left": left.current_version(), "right": right.current_version()}


def joined(frames):
    return frames["left"].join(frames["right"], (frames["left"]["day"] == frames["right"]["at"])
                               & (frames["left"]["k"] == frames["right"]["key"]), "left")


def texts(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def same(left, right, layout):
    now = state(left, right)
    got = layout.read(now)
    want = {"left": left.read(), "right": right.read()}
    assert all(texts(got[n]) == texts(want[n]) for n in want)
    assert texts(joined(got)) == texts(joined(want))
    return got


def planned(spark, make, broadcast=-1):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(broadcast))
    try:
        return plan_text(make(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_changes_add_folders_and_the_join_never_shuffles(spark, pair):
    left, right, layout = pair
    assert layout.read(state(left, right)) is None                              # nothing laid out yet
    layout.refresh(state(left, right), buckets=4)
    same(left, right, layout)
    assert layout.refresh(state(left, right)) is None                           # stands for it already
    for n in range(3):
        left.replace_partitions(spark.createDataFrame(
            [("k1", DATES[n], 1000 + n, DATES[n]), ("k9", DATES[5], 2000 + n, DATES[n])], LEFT), [DATES[n]])
        assert layout.read(state(left, right)) is None                          # the newer state is not laid out
        layout.refresh(state(left, right))
        got = same(left, right, layout)
        assert "Exchange" not in planned(spark, lambda got=got: joined(got))
    left.replace_partitions(spark.createDataFrame([], LEFT), [None, DATES[1]])   # partitions that are gone
    right.append(spark.createDataFrame([("k9", DATES[5], 9.0)], RIGHT))
    layout.refresh(state(left, right))
    got = same(left, right, layout)
    assert "Exchange" not in planned(spark, lambda: joined(got))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("colocated_")]


def test_only_changed_partitions_are_written(spark, pair):
    left, right, layout = pair
    layout.refresh(state(left, right), buckets=4)
    (first,) = layout._folders(layout._log.manifest()["partitions"])
    left.replace_partitions(spark.createDataFrame([("k1", DATES[0], 7, DATES[1])], LEFT), [DATES[1]])
    layout.refresh(state(left, right))
    parts = layout._log.manifest()["partitions"]
    new = {at for at, ws in parts.items() if ws != [first]}
    assert new == {f"left/{DATES[1]}"}
    (w,) = parts[f"left/{DATES[1]}"]
    assert spark.read.parquet(layout._folder(w, "left")).count() == 1


def test_many_folders_and_outgrown_buckets_are_written_anew(spark, pair, monkeypatch):
    left, right, layout = pair
    monkeypatch.setattr(C, "LAYERS", 3)
    layout.refresh(state(left, right))
    counts = []
    for n in range(5):
        left.replace_partitions(spark.createDataFrame([("k1", DATES[0], n, DATES[n % 3])], LEFT), [DATES[n % 3]])
        layout.refresh(state(left, right))
        counts.append(len(layout._folders(layout._log.manifest()["partitions"])))
        same(left, right, layout)
    assert max(counts) <= 3 and 1 in counts
    monkeypatch.setattr(C, "BUCKET_BYTES", 16)                                   # the same rows are many buckets now
    left.append(spark.createDataFrame([("k1", DATES[0], 99, DATES[5])], LEFT))
    layout.refresh(state(left, right))
    assert layout._log.manifest()["properties"]["buckets"] >= 16
    same(left, right, layout)


def test_a_vacuumed_state_leads_to_a_rebuild_and_two_writers_conflict(spark, pair):
    left, right, layout = pair
    layout.refresh(state(left, right), buckets=4)
    for n in range(3):
        left.replace_partitions(spark.createDataFrame([("k1", DATES[0], n, DATES[n])], LEFT), [DATES[n]])
    left.vacuum(1)
    layout.refresh(state(left, right))
    same(left, right, layout)
    left.replace_partitions(spark.createDataFrame([("k2", DATES[0], 5, DATES[0])], LEFT), [DATES[0]])
    other = C.Colocated(spark, layout._log.root, layout.tables, layout.keys)
    write, met = layout._write, []

    def between(*args):
        if not met:
            met.append(other.refresh(state(left, right)))
        write(*args)

    layout._write = between
    with pytest.raises(PublishConflict):
        layout.refresh(state(left, right))
    same(left, right, layout)
    assert len(layout._log._fs.list_dirs(layout._log.data_path)) >= 3
    layout.vacuum(1)
    same(left, right, layout)


def test_a_bucket_that_holds_most_rows_is_left_to_shuffled_joins(spark, pair, monkeypatch):
    left, right, layout = pair
    monkeypatch.setattr(C, "SKEW_BYTES", 100)
    monkeypatch.setattr(C, "SKEW_FACTOR", 2)
    left.write(spark.createDataFrame([("hot", DATES[0], i * 7919 % 10007, DATES[i % 3]) for i in range(5000)]
                                     + left_rows(200), LEFT))
    layout.refresh(state(left, right), buckets=8)
    assert layout.read(state(left, right)) is None


def test_empty_tables(spark, tmpdir_):
    left, right = PartitionedTable(spark, f"{tmpdir_}/l", "d"), PartitionedTable(spark, f"{tmpdir_}/r", "at")
    left.write(spark.createDataFrame([], LEFT))
    right.write(spark.createDataFrame([], RIGHT))
    layout = C.Colocated(spark, f"{tmpdir_}/c", {"left": left, "right": right}, {"left": ["day", "k"], "right": ["at", "key"]})
    layout.refresh(state(left, right))
    assert {n: f.count() for n, f in layout.read(state(left, right)).items()} == {"left": 0, "right": 0}


def test_the_fact_reads_buckets_and_equals_the_plain_fact(spark, tmpdir_):
    wh = daily.Warehouse(spark, f"{tmpdir_}/warehouse", f"{tmpdir_}/landing")
    for n, day in enumerate(DAYS[:2]):
        land_day(wh.landing, day)
        res = daily.run_daily(wh, day, as_of=f"2024-06-{10 + n} 06:00:00", colocate_fact=n == 0)
        assert res.status == "published" and res.steps["colocated"]
        held = Snapshots(spark, wh.root).current()
        plain = M.fact_trades(*(wh.catalog.table(m).read(held.get(m)) for m in daily.PUBLISHED))
        assert texts(daily.fact(wh)) == texts(plain) != []
        # officials are small enough to be broadcast, prices are not
        small = wh.catalog.table("int_gov_officials")._fs.size(wh.catalog.table("int_gov_officials").path())
        plan = planned(spark, lambda: daily.fact(wh), small)
        assert plan.count("Bucketed: true") >= 2 and "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan, plan
    daily.register_views(wh)
    assert texts(spark.table("fct_government_official_trades")) == texts(daily.fact(wh))
    # between publishing and the next refresh readers join the tables themselves
    daily.record_state(wh)
    t = wh.catalog.table("int_gov_official_trades")
    t.replace_partitions(t.read(), [r[0] for r in t.read().select("report_date").distinct().collect()])
    daily.record_state(wh)
    assert "Bucketed: true" not in planned(spark, lambda: daily.fact(wh))
    assert texts(daily.fact(wh)) == texts(plain)
