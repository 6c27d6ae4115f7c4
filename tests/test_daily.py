"""End-to-end: landed JSON for three run dates -> published, audited, versioned tables."""

import pytest

from civicledger.operators.quality import AuditFailed
from civicledger.plans import daily
from fixtures import DAYS, OFF_A, land_day, trade, write_array


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _snapshot_state(wh):
    names = ["int_gov_official_trades", "int_gov_officials", "int_market", "dim_scd_gov_officials",
             "stock_tickers", "market_close_by_day", "fct_government_official_trades"]
    return {n: sorted(map(lambda r: tuple(str(v) for v in r), wh.catalog.read(n).collect()))
            for n in names}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("wh")
    wh = daily.Warehouse(spark, f"{base}/warehouse", f"{base}/landing")
    return wh


def test_daily_runs(spark, warehouse):
    wh = warehouse
    land_day(wh.landing, DAYS[0])
    r1 = daily.run_daily(wh, DAYS[0], as_of="2024-06-10 06:00:00", materialize_fact=True)
    assert r1.status == "published"
    fact = wh.catalog.read("fct_government_official_trades")
    got = {r.transaction_id: r for r in fact.collect()}
    assert set(got) == {"T1", "T2"}                          # T3 has a blank ticker
    t1 = got["T1"]
    assert (t1.member_name, t1.party, t1.state, t1.state_iso_format, t1.chamber) == \
        ("Ada Quill", "Democrat", "Nebraska", "US-NE", "House of Representatives")
    assert (t1.transaction_miminum_value, t1.transaction_maximum_value, t1.transaction_median_value) == \
        (1001, 15000, 8001)
    assert (t1.is_purchase, t1.is_sale, t1.stock_volume) == (1, 0, 7080)
    t2 = got["T2"]
    assert (t2.state, t2.party, t2.chamber) == ("UNKNOWN", "Republican", "Senate")   # DC not in seed
    assert float(t2.stock_median) == 21.0 and t2.transaction_type == "Sale"
    # the duplicated QRTZ price was collapsed before publishing
    assert wh.catalog.read("market_close_by_day").where("symbol = 'QRTZ'").count() == 1
    tick = {r.ticker: r for r in wh.catalog.read("stock_tickers").collect()}
    assert set(tick) == {"LUMN", "QRTZ", "OLDX"}

    land_day(wh.landing, DAYS[1])
    # the day-1 ticker file has left the 7-day retention window by the second run
    import os
    import time
    old = time.mktime((2024, 6, 1, 0, 0, 0, 0, 0, 0))
    os.utime(f"{wh.landing}/stock_tickers/{DAYS[0]}_tickers.json.gz", (old, old))
    new = time.mktime((2024, 6, 11, 0, 0, 0, 0, 0, 0))
    os.utime(f"{wh.landing}/stock_tickers/{DAYS[1]}_tickers.json.gz", (new, new))
    r2 = daily.run_daily(wh, DAYS[1], as_of="2024-06-11 06:00:00", materialize_fact=True, ticker_retention_days=7)
    assert r2.status == "published"
    fact = wh.catalog.read("fct_government_official_trades")
    assert _rows(fact, "transaction_id") == [("T1",), ("T2",), ("T4",), ("T5",)]
    off = {r.member_id: r for r in wh.catalog.read("int_gov_officials").collect()}
    assert off["M001"].member_name == "Ada Quill-Sterne" and off["M003"].state == "Connecticut"
    dim = daily.dimension(wh, "dim_scd_gov_officials").where("member_id = 'M001'").orderBy("dbt_valid_from")
    assert [(r.member_name, r.dbt_valid_to is None) for r in dim.collect()] == \
        [("Ada Quill", False), ("Ada Quill-Sterne", True)]
    tick2 = {r.ticker: r for r in wh.catalog.read("stock_tickers").collect()}
    assert set(tick2) == {"LUMN", "QRTZ", "VRDA"}                 # OLDX gone, VRDA new
    assert tick2["LUMN"].name == "Lumen Lamps Intl"
    assert tick2["QRTZ"].watermark_timestamp == tick["QRTZ"].watermark_timestamp   # unchanged row kept

    # the ticker dimension (defined in the source project, not run by its DAG)
    assert daily.snapshot_tickers(wh, "2024-06-11 06:00:00") is not None
    scd_t = {(r.ticker, r.dbt_valid_to is None) for r in daily.dimension(wh, "scd_tickers").collect()}
    assert scd_t == {("LUMN", True), ("QRTZ", True), ("VRDA", True)}
    # freshness from the ledgers: trades and prices were landed moments ago, the newest ticker file on 2024-06-11
    import datetime as _dt
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    fresh = {r.table_name: r.status for r in daily.source_freshness(wh, now).collect()}
    assert fresh == {"government_trades": "pass", "market_close_by_day": "pass", "stock_tickers": "error"}
    then = {r.table_name: r.status for r in daily.source_freshness(wh, "2024-06-11 12:00:00").collect()}
    assert then["stock_tickers"] == "pass"

    # old versions are vacuumed down to the retention; the current one stays
    assert daily.vacuum(wh, keep=1)["int_gov_officials"] == [1]
    assert wh.catalog.table("int_gov_officials").versions() == [2]

    # the whole-table post-publish tests agree with the incremental ones the run used
    assert [r["failures"] for r in r2.steps["published_report"]] == [0] * 6
    assert [r.failures for r in daily.post_publish_report(wh, {}, "full").collect()] == [0] * 6

    # re-running a day changes nothing
    before = _snapshot_state(wh)
    r2b = daily.run_daily(wh, DAYS[1], as_of="2024-06-11 06:00:00", materialize_fact=True, ticker_retention_days=7)
    assert r2b.status == "published" and r2b.steps["trades_batches"] == []
    after = _snapshot_state(wh)
    assert {k: v for k, v in after.items() if k != "stock_tickers"} == \
        {k: v for k, v in before.items() if k != "stock_tickers"}
    assert [r[:10] for r in after["stock_tickers"]] == [r[:10] for r in before["stock_tickers"]]

    # a run date without trades is skipped, tables unchanged
    land_day(wh.landing, DAYS[2])
    os.utime(f"{wh.landing}/stock_tickers/{DAYS[2]}_tickers.json.gz", (new, new))
    versions = {n: wh.catalog.table(n).current_version() for n in
                ("int_gov_officials", "fct_government_official_trades")}
    trades_before = _snapshot_state(wh)["int_gov_official_trades"]
    dim_before = _snapshot_state(wh)["dim_scd_gov_officials"]
    r3 = daily.run_daily(wh, DAYS[2], as_of="2024-06-12 06:00:00", materialize_fact=True, ticker_retention_days=7)
    assert r3.status == "skipped"
    assert versions == {n: wh.catalog.table(n).current_version() for n in versions}
    assert _snapshot_state(wh)["int_gov_official_trades"] == trades_before
    assert _snapshot_state(wh)["dim_scd_gov_officials"] == dim_before

    # an audit failure publishes nothing
    write_array(f"{wh.landing}/government_trades/2024-06-13_government_trades.json.gz",
                [trade("T9", OFF_A, "LUMN", "P", "Over $50,000,000", "2024-06-07", "2024-06-13")])
    with pytest.raises(AuditFailed) as e:
        daily.run_daily(wh, "2024-06-13", as_of="2024-06-13 06:00:00", materialize_fact=True)
    assert {f["column_name"] for f in e.value.failures} == {"maximum_value", "median_value"}
    assert versions == {n: wh.catalog.table(n).current_version() for n in versions}
    assert _snapshot_state(wh)["int_gov_official_trades"] == trades_before


def test_fact_view_prunes_price_partitions(spark, warehouse):
    """A date filter on the fact view reaches the price fact's partitions through the join."""
    from pyspark.sql import functions as F

    from planutil import plan_text
    q = daily.fact(warehouse).where(F.col("transaction_date") == F.lit("2024-06-03").cast("date"))
    plan = plan_text(q)
    assert "PartitionFilters: [(date_recorded" in plan and "= 2024-06-03)" in plan
    assert [r.transaction_id for r in q.collect()] == ["T1"]


def test_backfill_equals_day_by_day(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("bf")
    day_by_day = daily.Warehouse(spark, f"{base}/a", f"{base}/land_a")
    for d in DAYS[:2]:
        land_day(day_by_day.landing, d)
        daily.run_daily(day_by_day, d, as_of=f"{d} 06:00:00")
    one_job = daily.Warehouse(spark, f"{base}/b", f"{base}/land_b")
    for d in DAYS[:2]:
        land_day(one_job.landing, d)
    daily.load_trades(one_job)
    daily.load_and_dedup_market(one_job, "2024-06-11 06:00:00")
    daily.run_backfill(one_job, DAYS[0], DAYS[1])
    scd = [sorted(map(tuple, daily.dimension(w, "dim_scd_gov_officials").collect()), key=str)
           for w in (day_by_day, one_job)]
    assert scd[0] == scd[1]
    for name in ("int_gov_officials", "int_gov_official_trades", "int_market"):
        a = sorted(map(tuple, day_by_day.catalog.read(name).collect()), key=str)
        b = sorted(map(tuple, one_job.catalog.read(name).collect()), key=str)
        assert a == b, name


def test_backfill_refuses_ranges_reaching_today(spark, tmp_path_factory):
    import datetime as dt
    base = tmp_path_factory.mktemp("bf2")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    with pytest.raises(ValueError):
        daily.run_backfill(wh, "2024-06-10", "2024-06-12", today=dt.date(2024, 6, 12))
    with pytest.raises(ValueError):
        daily.run_backfill(wh, "2024-06-12", "2024-06-10", today=dt.date(2024, 7, 1))


def test_run_without_price_or_ticker_feeds(spark, tmp_path_factory):
    """Only trades landed: prices are simply missing (NULL stock_* in the fact)."""
    base = tmp_path_factory.mktemp("noprice")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    write_array(f"{wh.landing}/government_trades/{DAYS[0]}_government_trades.json.gz",
                [trade("T1", OFF_A, "LUMN", "P", "$1,001 - $15,000", "2024-06-03", DAYS[0])])
    r = daily.run_daily(wh, DAYS[0], as_of=f"{DAYS[0]} 06:00:00")
    assert r.status == "published"
    rows = daily.fact(wh).collect()
    assert len(rows) == 1 and rows[0].stock_close is None and rows[0].member_name == "Ada Quill"


def test_command_line(spark, tmp_path_factory, capsys):
    from civicledger.plans import cli
    base = tmp_path_factory.mktemp("cli")
    land_day(f"{base}/l", DAYS[0])
    common = ["--root", f"{base}/w", "--landing", f"{base}/l", "--as-of", f"{DAYS[0]} 06:00:00"]
    out = cli.run(["daily", "--run-date", DAYS[0], *common], spark=spark)
    assert out["status"] == "published" and "publish" in out["seconds"]
    fresh = cli.run(["freshness", "--root", f"{base}/w", "--landing", f"{base}/l"], spark=spark)
    assert {t["table_name"] for t in fresh["tables"]} == {"government_trades", "market_close_by_day", "stock_tickers"}
    skipped = cli.run(["daily", "--run-date", "2024-06-30", *common], spark=spark)
    assert skipped["status"] == "skipped"


def test_price_merge_recovers(spark, tmp_path_factory):
    """Prices loaded by a run that died before the merge are merged by the next run;
    a merge re-run after losing its marker changes nothing."""
    base = tmp_path_factory.mktemp("recover")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    land_day(wh.landing, DAYS[0])
    daily.load_and_dedup_market(wh, "2024-06-10 06:00:00")
    first = sorted(map(tuple, wh.catalog.read("market_close_by_day").collect()), key=str)
    land_day(wh.landing, DAYS[1])
    # the day-2 run dies right after loading its price file
    from civicledger.sources import landing as L
    from civicledger.streaming.incremental import load_new_files
    from civicledger.sources import schemas
    load_new_files(L.case_sensitive(spark), f"{wh.landing}/market_close", schemas.MARKET_CLOSE, wh.market_loads_path,
                   wh.catalog.checkpoint_location("market_close"), name_glob=L.MARKET_GLOB,
                   transform=L.extract_market_rows)
    touched = daily.load_and_dedup_market(wh, "2024-06-11 06:00:00")      # next run: no new files
    assert touched and sorted(map(str, touched)) == ["2024-06-05"]
    merged = sorted(map(tuple, wh.catalog.read("market_close_by_day").collect()), key=str)
    assert len(merged) == len(first) + 2
    # a batch that is merged again replaces its own rows
    t = wh.catalog.table("market_close_by_day")
    t.replace_partitions(t.read().where("false"), [], properties={daily.MERGED_THROUGH: 0})
    daily.load_and_dedup_market(wh, "2024-06-11 06:00:00")
    assert sorted(map(tuple, wh.catalog.read("market_close_by_day").collect()), key=str) == merged


def test_first_build_tests_the_whole_history(spark, tmp_path_factory):
    """A duplicate in history, outside the run date's slice, fails the first run."""
    base = tmp_path_factory.mktemp("history")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    for day, txn in ((DAYS[0], "T1"), (DAYS[1], "T2"), ("2024-06-12", "T3")):
        t = trade(txn, OFF_A, "LUMN", "P", "$1,001 - $15,000", "2024-06-03", day)
        if txn != "T3":
            t["id"] = "same-record"
        write_array(f"{wh.landing}/government_trades/{day}_government_trades.json.gz", [t])
    from civicledger.operators.quality import AuditFailed
    for _ in range(2):                                        # and again, until it is mended
        with pytest.raises(AuditFailed):
            daily.run_daily(wh, "2024-06-12", as_of="2024-06-12 06:00:00")
    assert not daily.passed_in_full(wh)


def test_backfill_stops_where_the_daily_run_stops(spark, tmp_path_factory):
    from civicledger.operators.quality import AuditFailed
    base = tmp_path_factory.mktemp("bfgate")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    write_array(f"{wh.landing}/government_trades/{DAYS[0]}_government_trades.json.gz",
                [trade("T1", OFF_A, "LUMN", "P", "$1,001 - $15,000", "2024-06-03", DAYS[0])])
    write_array(f"{wh.landing}/government_trades/{DAYS[1]}_government_trades.json.gz",
                [trade("T9", OFF_A, "LUMN", "P", "Over $50,000,000", "2024-06-07", DAYS[1])])
    with pytest.raises(AuditFailed):
        daily.run_backfill(wh, DAYS[0], DAYS[1])
    for name in ("int_gov_officials", "int_gov_official_trades", "int_market", "dim_scd_gov_officials"):
        assert not wh.catalog.exists(name)


def test_old_ticker_files_stay_and_an_empty_mirror_is_refused(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tick")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l")
    land_day(wh.landing, DAYS[0])
    daily.sync_tickers(wh, "2024-06-10 06:00:00")
    n = wh.catalog.read("stock_tickers").count()
    daily.sync_tickers(wh, "2099-01-01 06:00:00")
    assert n and wh.catalog.read("stock_tickers").count() == n
    from civicledger.sources.store import EmptyVersionError
    with pytest.raises(EmptyVersionError):
        daily.sync_tickers(wh, "2099-01-01 06:00:00", refuse_empty=True, retention_days=7)
    assert wh.catalog.read("stock_tickers").count() == n


def test_landed_files_that_no_pattern_matches_raise(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("glob")
    spark.createDataFrame([(1,)], "id int").write.json(f"{base}/l/government_trades")
    wh = daily.Warehouse(spark, f"{base}/w", f"{base}/l", layout="lines")
    with pytest.raises(FileNotFoundError, match="no file matches"):
        daily.run_daily(wh, DAYS[0])


def test_default_run_date_is_utc_yesterday():
    import datetime as dt
    assert daily.default_run_date(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)
    assert daily.default_run_date() == dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)


def test_command_line_exit_code_on_audit_failure(spark, tmp_path_factory, capsys):
    import json as _json

    from civicledger.plans import cli
    base = tmp_path_factory.mktemp("cli_fail")
    write_array(f"{base}/l/government_trades/2024-06-13_government_trades.json.gz",
                [trade("T9", OFF_A, "LUMN", "P", "Over $50,000,000", "2024-06-07", "2024-06-13")])
    code = cli.main(["daily", "--run-date", "2024-06-13", "--root", f"{base}/w", "--landing", f"{base}/l",
                     "--as-of", "2024-06-13 06:00:00"])
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 2 and out["status"] == "audit_failed"
    assert {f["column_name"] for f in out["failures"]} == {"maximum_value", "median_value"}
