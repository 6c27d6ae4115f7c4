"""Backfill in windows: a stop keeps what is done, a re-run goes on behind it, tickers follow the dates."""

import pytest

from civicledger.plans import backfill, daily
from fixtures import DAYS, OFF_A, land_day, trade, write_array


def state(wh):
    names = ["int_gov_official_trades", "int_gov_officials", "int_market"]
    out = {n: sorted(map(str, wh.catalog.read(n).collect())) for n in names}
    out["scd"] = sorted(map(str, daily.dimension(wh, "dim_scd_gov_officials").collect()))
    tickers = wh.catalog.read("stock_tickers").drop("watermark_timestamp").collect()
    return out | {"tickers": sorted(map(str, tickers))}


def test_windows():
    import datetime as dt
    d = dt.date
    assert list(backfill.windows(d(2024, 1, 1), d(2024, 1, 5), 2)) == [
        (d(2024, 1, 1), d(2024, 1, 2)), (d(2024, 1, 3), d(2024, 1, 4)), (d(2024, 1, 5), d(2024, 1, 5))]
    assert list(backfill.windows(d(2024, 1, 1), d(2024, 1, 5), None)) == [(d(2024, 1, 1), d(2024, 1, 5))]


def test_a_stop_in_the_second_window_keeps_the_first(spark, tmp_path_factory, monkeypatch):
    base = tmp_path_factory.mktemp("windows")
    wh = daily.Warehouse(spark, f"{base}/b", f"{base}/l")
    for d in DAYS[:2]:
        land_day(wh.landing, d)
    worked = []
    real = daily._backfill_window

    def stops(wh_, dates, *rest):
        worked.append([str(d) for d in dates])
        if DAYS[1] in worked[-1] and len(worked) == 2:
            raise OSError("stopped")
        return real(wh_, dates, *rest)

    monkeypatch.setattr(daily, "_backfill_window", stops)
    with pytest.raises(OSError):
        daily.run_backfill(wh, DAYS[0], DAYS[1], as_of="2024-06-12 06:00:00", window_days=1)
    assert {r.transaction_id for r in wh.catalog.read("int_gov_official_trades").collect()} == {"T1", "T2"}
    assert {r.ticker for r in wh.catalog.read("stock_tickers").collect()} == {"LUMN", "QRTZ", "OLDX"}   # as of the first date
    out = daily.run_backfill(wh, DAYS[0], DAYS[1], as_of="2024-06-12 06:00:00", window_days=1)
    assert worked == [[DAYS[0]], [DAYS[1]], [DAYS[1]]] and out["windows"] == [[DAYS[1], DAYS[1]]]
    day_by_day = daily.Warehouse(spark, f"{base}/a", f"{base}/la")
    for d in DAYS[:2]:
        land_day(day_by_day.landing, d)
        daily.run_daily(day_by_day, d, as_of="2024-06-12 06:00:00", keep_versions=None)
    assert state(wh) == state(day_by_day)
    # through: the record is gone, and the range can be run again, without a change
    before = state(wh)
    again = daily.run_backfill(wh, DAYS[0], DAYS[1], as_of="2024-06-12 07:00:00", window_days=1)
    assert len(again["windows"]) == 2 and state(wh) == before


def test_a_failing_window_publishes_nothing_of_itself(spark, tmp_path_factory):
    from civicledger.operators.quality import AuditFailed
    base = tmp_path_factory.mktemp("failing")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    write_array(f"{wh.landing}/government_trades/{DAYS[0]}_government_trades.json.gz",
                [trade("T1", OFF_A, "LUMN", "P", "$1,001 - $15,000", "2024-06-03", DAYS[0])])
    write_array(f"{wh.landing}/government_trades/{DAYS[1]}_government_trades.json.gz",
                [trade("T9", OFF_A, "LUMN", "P", "Over $50,000,000", "2024-06-07", DAYS[1])])
    with pytest.raises(AuditFailed):
        daily.run_backfill(wh, DAYS[0], DAYS[1], window_days=1)
    assert [r.transaction_id for r in wh.catalog.read("int_gov_official_trades").collect()] == ["T1"]


def test_packed_tables_read_and_change_like_others(spark, tmpdir_):
    import datetime as dt

    from civicledger.operators.merge import upsert_partitions
    from civicledger.sources.store import PACKED, PartitionedTable
    from planutil import plan_text
    t = PartitionedTable(spark, f"{tmpdir_}/t", "d", ["k"])
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    rows = [(f"k{i}", i, d) for i, d in enumerate(days)] + [("none", -1, None)]
    t.write(spark.createDataFrame(rows, "k string, v int, d date"), pack=True)
    assert all(w.startswith(PACKED) for ws in t.manifest()["partitions"].values() for w in ws)
    got = lambda: sorted(map(str, (tuple(r) for r in t.read().collect())))
    assert got() == sorted(map(str, rows))
    assert [r.k for r in t.read_partitions([days[3]]).collect()] == ["k3"]
    assert [r.k for r in t.read_partitions([None]).collect()] == ["none"]
    assert "PushedFilters: [IsNotNull(d), EqualTo(d,2024-01-04)]" in plan_text(t.read().where("d = date'2024-01-04'"))
    # a key moves out of a packed date, another is replaced in place, one is new
    src = spark.createDataFrame([("k3", 30, days[9]), ("k5", 50, days[5]), ("new", 1, dt.date(2025, 1, 1))], "k string, v int, d date")
    upsert_partitions(t, src, "k")
    want = sorted(map(str, [r for r in rows if r[0] not in ("k3", "k5")] + [tuple(r) for r in src.collect()]))
    assert got() == want
    t.replace_partitions(spark.createDataFrame([], "k string, v int, d date"), [None])
    want = [r for r in want if "none" not in r]
    assert got() == want
    # compaction: the same rows, fewer folders, then vacuum
    assert t.compact(from_folders=50) is None
    assert t.compact(from_folders=2) and got() == want
    assert all(w.startswith(PACKED) for ws in t.manifest()["partitions"].values() for w in ws)
    t.vacuum(1, lease_seconds=0)
    assert got() == want and len(t._fs.list_dirs(t.data_path)) == 2
