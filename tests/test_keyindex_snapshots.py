"""The key index beside a partitioned table, and SQL views bound to one state of several tables."""

import datetime as dt

import pytest

from civicledger.operators.merge import upsert_partitions
from civicledger.plans import daily
from civicledger.sources.keyindex import KeyIndex
from civicledger.sources.store import KEY_INDEX, PartitionedTable
from fixtures import DAYS, land_day

SCHEMA = "k string, v int, d date"
DATES = [dt.date(2024, 6, 1) + dt.timedelta(days=i) for i in range(6)]


def table(spark, root):
    t = PartitionedTable(spark, root, "d", ["k"])
    if not t.exists():
        t.write(spark.createDataFrame([(f"k{i}", i, DATES[i % 5]) for i in range(50)] + [(None, -1, DATES[0])], SCHEMA))
    return t


def rows(t):
    return sorted(map(str, (tuple(r) for r in t.read().collect())))


def plain(state, source):
    keys = {s[0] for s in source if s[0] is not None}
    return [r for r in state if r[0] is None or r[0] not in keys] + source


def test_merges_by_the_index_equal_plain_merges(spark, tmpdir_):
    t = table(spark, f"{tmpdir_}/t")
    state = [(f"k{i}", i, DATES[i % 5]) for i in range(50)] + [(None, -1, DATES[0])]
    batches = [[("k1", 100, DATES[1]), ("new", 1, DATES[5])], [("k1", 101, DATES[3]), ("k7", 7, None)],
               [("k7", 70, DATES[0]), ("new", 2, DATES[5]), (None, -2, DATES[5])], [("k49", 0, DATES[2])]]
    for n, batch in enumerate(batches):
        assert KeyIndex(t, ["k"]).exists() == (n > 0) and KEY_INDEX not in t.properties()
        upsert_partitions(t, spark.createDataFrame(batch, SCHEMA), "k")
        state = plain(state, batch)
        assert rows(t) == sorted(map(str, state)), n


def test_a_merge_reads_the_buckets_of_its_keys_only(spark, tmpdir_):
    t = table(spark, f"{tmpdir_}/t")
    index = KeyIndex(t, ["k"])
    assert not index.exists()
    index.build()
    source = spark.createDataFrame([("k3", 0, DATES[5]), ("k8", 0, DATES[5]), ("unknown", 0, DATES[5])], SCHEMA)
    found = index.partitions_of(source)
    assert [r["at"] for r in found.collect()] == [str(DATES[3])]
    files = [f for f in found.inputFiles() if t.root in f]
    assert files and all("/_keys/" in f for f in files)                        # no file of the table itself
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) <= 3
    read = []
    real = t.read_partitions
    t.read_partitions = lambda values, schema=None: read.append(sorted(map(str, values))) or real(values, schema)
    t.read = lambda *a: pytest.fail("the whole table was read")
    upsert_partitions(t, source, "k")
    assert read == [[str(DATES[3]), str(DATES[5])]]


def test_a_merge_that_stops_after_its_index_is_made_good(spark, tmpdir_, monkeypatch):
    t = table(spark, f"{tmpdir_}/t")
    KeyIndex(t, ["k"]).build()
    batch = spark.createDataFrame([("k1", 100, DATES[5])], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(t, "replace_partitions", lambda *a, **k: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            upsert_partitions(t, batch, "k")
    fresh = table(spark, f"{tmpdir_}/t")
    other = spark.createDataFrame([("k2", 200, DATES[5])], SCHEMA)
    upsert_partitions(fresh, other, "k")
    upsert_partitions(fresh, batch, "k")
    want = plain(plain([(f"k{i}", i, DATES[i % 5]) for i in range(50)] + [(None, -1, DATES[0])], [("k2", 200, DATES[5])]),
                 [("k1", 100, DATES[5])])
    assert rows(fresh) == sorted(map(str, want))
    # a change that knows nothing of the index leaves the table without one
    fresh.replace_partitions(spark.createDataFrame([], SCHEMA), [DATES[5]])
    assert not KeyIndex(fresh, ["k"]).exists()
    assert KeyIndex(fresh, ["k"]).vacuum(1) is not None


def test_sql_reads_one_state_during_a_publish(spark, tmp_path_factory, monkeypatch):
    base = tmp_path_factory.mktemp("views")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    land_day(wh.landing, DAYS[0])
    daily.run_daily(wh, DAYS[0], as_of="2024-06-10 06:00:00")
    text = """SELECT t.transaction_id, o.member_name, m.stock_volume FROM int_gov_official_trades t
              LEFT JOIN int_gov_officials o USING (member_id)
              LEFT JOIN int_market m ON m.date_recorded = t.transaction_date AND m.ticker = t.security_ticker"""
    by_sql = lambda: sorted(map(str, (tuple(r) for r in spark.sql(text).collect())))
    by_fact = lambda: sorted(map(str, (tuple(r) for r in daily.fact(wh).select(
        "transaction_id", "member_name", "stock_volume").collect())))
    assert set(daily.register_views(wh)) >= {"int_gov_official_trades", "int_gov_officials", "int_market",
                                             "fct_government_official_trades"}
    first = by_sql()
    assert first == by_fact() and len(first) == 2
    assert spark.sql("SELECT count(*) FROM fct_government_official_trades").first()[0] == 2
    land_day(wh.landing, DAYS[1])
    seen = []
    real = daily.record_state

    def midway(wh_):                    # all three tables are published, the common state is not recorded yet
        daily.register_views(wh_)
        seen.append((by_sql(), by_fact()))
        return real(wh_)
    monkeypatch.setattr(daily, "record_state", midway)
    daily.run_daily(wh, DAYS[1], as_of="2024-06-11 06:00:00", keep_versions=1)
    assert seen == [(first, first)]
    daily.register_views(wh)
    assert by_sql() == by_fact() and len(by_sql()) == 4
