"""Loads by content: landed again, corrected, shrunk, bad, stopped and stale files."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from civicledger.plans import cli, daily
from civicledger.sources import landing, ledger, schemas
from civicledger.sources.store import PublishConflict
from fixtures import DAYS, OFF_A, price, ticker, trade, write_array


def warehouse(spark, base, **how):
    return daily.Warehouse(spark, f"{base}/w", f"{base}/l", **how)


def trades(wh):
    return sorted((r.transaction_id, r.security_ticker, str(r.report_date)) for r in wh.trades_source().collect())


def one(tid, symbol="LUMN", day=DAYS[0]):
    return trade(tid, OFF_A, symbol, "P", "$1,001 - $15,000", "2024-06-03", day)


def test_a_day_landed_twice_ends_with_its_second_content(spark, tmpdir_):
    wh = warehouse(spark, tmpdir_, layout="lines")
    feed = lambda records: spark.read.schema(schemas.GOVERNMENT_TRADES).json(
        spark.sparkContext.parallelize([json.dumps(r) for r in records], 2))
    path = f"{wh.landing}/government_trades"
    landing.write_landing(feed([one("T1"), one("T2")]), path, DAYS[0])
    landing.write_landing(feed([one("T8", day=DAYS[1])]), path, DAYS[1])
    assert daily.load_trades(wh) and len(trades(wh)) == 3
    assert daily.load_trades(wh) == []
    # landed again with the same content, in other files' bytes: nothing is added
    landing.write_landing(feed([one("T8", day=DAYS[1])]), path, DAYS[1])
    daily.load_trades(wh)
    assert len(trades(wh)) == 3
    # landed again with other rows, in fewer files
    landing.write_landing(feed([one("T1", "QRTZ")]).coalesce(1), path, DAYS[0])
    assert daily.load_trades(wh)
    assert trades(wh) == [("T1", "QRTZ", DAYS[0]), ("T8", "LUMN", DAYS[1])]
    assert daily.load_trades(wh) == []


def test_a_corrected_file_replaces_its_rows_wherever_they_went(spark, tmpdir_):
    wh = warehouse(spark, tmpdir_)
    first = f"{wh.landing}/government_trades/a_government_trades.json.gz"
    write_array(first, [one("T1"), one("T2", day=DAYS[1])])
    write_array(f"{wh.landing}/government_trades/b_government_trades.json.gz", [one("T3"), one("T1")])
    daily.load_trades(wh)
    write_array(first, [one("T1", "VRDA", DAYS[2])])
    daily.load_trades(wh)
    assert trades(wh) == [("T1", "LUMN", DAYS[0]), ("T1", "VRDA", DAYS[2]), ("T3", "LUMN", DAYS[0])]
    # a file that expires keeps its rows; one that is only touched adds none
    os.remove(first)
    os.utime(f"{wh.landing}/government_trades/b_government_trades.json.gz", (1, 1))
    write_array(f"{wh.landing}/government_trades/c_government_trades.json.gz", [])
    daily.load_trades(wh)
    assert len(trades(wh)) == 3
    held = {os.path.basename(r.file): r for r in ledger.entries(spark, wh.catalog.table(daily.TRADES)).collect()}
    assert {k: (r.n_rows, sorted(r.partitions)) for k, r in held.items()} == {
        "a_government_trades.json.gz": (1, [DAYS[2]]), "b_government_trades.json.gz": (2, [DAYS[0]]),
        "c_government_trades.json.gz": (0, [])}
    assert daily.load_trades(wh) == []


def test_a_load_that_dies_changes_nothing_and_two_at_once_load_once(spark, tmpdir_, monkeypatch):
    wh = warehouse(spark, tmpdir_)
    write_array(f"{wh.landing}/government_trades/a_government_trades.json.gz", [one("T1")])
    daily.load_trades(wh)
    write_array(f"{wh.landing}/government_trades/b_government_trades.json.gz", [one("T2")])
    from civicledger.sources.store import PartitionedTable
    with monkeypatch.context() as m:
        m.setattr(PartitionedTable, "_append", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            daily.load_trades(wh)
    assert len(trades(wh)) == 1
    real = ledger._write_ledger

    def raced(*args):                                       # another load finishes while this one is about to publish
        monkeypatch.setattr(ledger, "_write_ledger", real)
        daily.load_trades(wh)
        return real(*args)
    monkeypatch.setattr(ledger, "_write_ledger", raced)
    with pytest.raises(PublishConflict):
        daily.load_trades(wh)
    assert len(trades(wh)) == 2 and daily.load_trades(wh) == []


def test_skip_file_keeps_bad_files_out_and_loads_the_rest(spark, tmpdir_):
    wh = warehouse(spark, tmpdir_, on_error="skip_file")
    at = f"{wh.landing}/government_trades"
    bad = lambda n, total, tag: [one(f"{tag}{i}") | ({"report_date": "no date"} if i < n else {}) for i in range(total)]
    write_array(f"{at}/nine_government_trades.json.gz", bad(9, 100, "N"))
    write_array(f"{at}/eleven_government_trades.json.gz", bad(11, 100, "E"))
    with gzip.open(f"{at}/broken_government_trades.json.gz", "wt") as f:
        f.write('[{"id": "x", ')
    daily.load_trades(wh)
    assert len(trades(wh)) == 91 and all(t[0].startswith("N") for t in trades(wh))
    kept_out = {os.path.basename(r.file): (r.n_rows, r.n_bad) for r in daily.quarantine(wh).collect()}
    assert kept_out == {"eleven_government_trades.json.gz": (100, 11), "broken_government_trades.json.gz": (1, 1)}
    rejects = spark.read.json(f"{wh.trades_path}/_rejects", recursiveFileLookup=True)
    assert rejects.count() == 9 and "no date" in rejects.first()["record"]
    listed = cli.run(["quarantine", "--root", wh.root, "--landing", wh.landing], spark=spark)["files"]
    assert {os.path.basename(f["file"]) for f in listed} == set(kept_out)
    # typed rows are those of the strict load
    strict = warehouse(spark, f"{tmpdir_}/strict")
    write_array(f"{strict.landing}/government_trades/x_government_trades.json.gz", bad(0, 100, "N")[9:])
    daily.load_trades(strict)
    drop = lambda w: sorted(map(str, w.trades_source().collect()))
    assert drop(wh) == drop(strict)
    # mended, the file is loaded
    write_array(f"{at}/eleven_government_trades.json.gz", bad(0, 100, "E"))
    daily.load_trades(wh)
    assert len(trades(wh)) == 191 and daily.quarantine(wh).count() == 1
    with pytest.raises(Exception):
        daily.load_trades(warehouse(spark, f"{tmpdir_}/other") if False else
                          daily.Warehouse(spark, f"{tmpdir_}/w2", wh.landing))        # the strict policy stops


def test_pages_of_the_api_load_as_they_are(spark, tmpdir_):
    for policy in ("abort", "skip_file"):
        wh = daily.Warehouse(spark, f"{tmpdir_}/{policy}", f"{tmpdir_}/l", layout="pages", on_error=policy)
        os.makedirs(f"{wh.landing}/government_trades", exist_ok=True)
        for i, page in enumerate([{"results": [one("T1"), one("T2")], "next_url": "x"}, {"data": [one("T3")]}, {"results": []}]):
            with gzip.open(f"{wh.landing}/government_trades/{i}_government_trades.json.gz", "wt") as f:
                json.dump(page, f)
        daily.load_trades(wh)
        assert [t[0] for t in trades(wh)] == ["T1", "T2", "T3"]


def test_corrected_prices_reach_the_price_table(spark, tmpdir_):
    wh = warehouse(spark, tmpdir_)
    a, b = (f"{wh.landing}/market_close/{x}_market_close.json.gz" for x in "ab")
    write_array(a, [price("LUMN", "2024-06-03", 1, 2, 1, 2, 10), price("QRTZ", "2024-06-03", 5, 6, 5, 6, 10)])
    write_array(b, [price("LUMN", "2024-06-03", 1, 2, 1, 2, 10), price("VRDA", "2024-06-04", 7, 8, 7, 8, 10)])
    closes = lambda: sorted((r.symbol, float(r.close)) for r in wh.prices().collect())
    daily.load_and_dedup_market(wh, "2024-06-10 06:00:00")
    assert closes() == [("LUMN", 2.0), ("QRTZ", 6.0), ("VRDA", 8.0)]
    write_array(a, [price("LUMN", "2024-06-03", 1, 2, 1, 2, 10), price("QRTZ", "2024-06-03", 5, 6, 5, 5.5, 10)])
    # the price table is far behind and the date is old by then: the corrected date still holds each row once
    assert daily.load_and_dedup_market(wh, "2024-12-10 06:00:00") == ["2024-06-03"]
    assert closes() == [("LUMN", 2.0), ("QRTZ", 5.5), ("VRDA", 8.0)]
    assert daily.load_and_dedup_market(wh, "2024-12-10 06:00:00") is None


def test_an_old_ticker_file_is_stale_however_often_it_is_mirrored(spark, tmpdir_):
    import time
    wh = warehouse(spark, tmpdir_)
    f = f"{wh.landing}/stock_tickers/a_tickers.json.gz"
    write_array(f, [ticker("LUMN", "Lumen Lamps", "2024-06-01T00:00:00Z")])
    old = time.time() - 10 * 86400
    os.utime(f, (old, old))
    now = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())
    daily.sync_tickers(wh, now)
    daily.sync_tickers(wh, now)
    got = {r.table_name: (r.status, r.age_seconds) for r in daily.source_freshness(wh, now).collect()}
    assert got["stock_tickers"][0] == "error" and abs(got["stock_tickers"][1] - 10 * 86400) < 60
    assert got["government_trades"] == ("error", None)                          # never loaded
    assert spark.read.parquet(wh.catalog.table(daily.TICKER_FILES).path()).select(F.count("file")).first()[0] == 1
