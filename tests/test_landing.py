import gzip
import json
import os

from pyspark.sql import functions as F

from civicledger.sources import landing, schemas
from fixtures import land_day, price, write_array


def test_read_and_extract_trades(spark, tmpdir_):
    land_day(tmpdir_, "2024-06-10")
    raw = landing.read_landed(spark, f"{tmpdir_}/government_trades", schemas.GOVERNMENT_TRADES,
                              name_glob=landing.TRADES_GLOB)
    src = landing.extract_trades(raw)
    assert len(src.columns) == 28
    rows = {r.transaction_id: r for r in src.collect()}
    assert set(rows) == {"T1", "T2", "T3"}
    assert rows["T1"].member_id == "M001" and rows["T1"].security_ticker == "LUMN"
    assert json.loads(rows["T1"].committees) == {"Committee on Lighthouses": ["Fog Signals"]}
    assert json.loads(rows["T1"].leadership_positions) == ["Deputy Whip"]
    assert rows["T3"].security_ticker == ""


def test_market_extract_both_spellings_and_volume(spark, tmpdir_):
    land_day(tmpdir_, "2024-06-10")
    recs = landing.read_records(spark, f"{tmpdir_}/market_close", name_glob=landing.MARKET_GLOB)
    out = {(r.symbol, r.stock_volume, float(r.after_hours)) for r in landing.extract_market(recs).collect()}
    assert ("LUMN", 7080, 10.6) in out             # 7079.6 rounds, afterHours spelling
    assert ("QRTZ", 1200, 21.1) in out             # all-lower-case spelling


def test_name_glob_filters_files(spark, tmpdir_):
    write_array(f"{tmpdir_}/mixed/2024-06-10_market_close.json.gz",
                [price("AAA", "2024-06-10", 1, 2, 1, 2, 10)])
    write_array(f"{tmpdir_}/mixed/2024-06-10_other.json.gz",
                [price("BBB", "2024-06-10", 1, 2, 1, 2, 10)])
    recs = landing.read_records(spark, f"{tmpdir_}/mixed", name_glob=landing.MARKET_GLOB)
    assert [r.symbol for r in landing.extract_market(recs).collect()] == ["AAA"]


def test_pages_envelope(spark, tmpdir_):
    for i, recs in enumerate([[{"ticker": "A"}, {"ticker": "B"}], [{"ticker": "C"}]]):
        p = f"{tmpdir_}/pages/page{i}_tickers.json.gz"
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with gzip.open(p, "wt") as f:
            json.dump({"results": recs, "next_url": None}, f)
    out = landing.read_pages(spark, f"{tmpdir_}/pages", schemas.TICKERS, "results")
    assert sorted(r.ticker for r in out.collect()) == ["A", "B", "C"]


def test_write_landing_overwrites_rerun(spark, tmpdir_):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "t string, v int")
    landing.write_landing(df, f"{tmpdir_}/land", "2024-06-10")
    landing.write_landing(df.limit(1), f"{tmpdir_}/land", "2024-06-10")
    landing.write_landing(df, f"{tmpdir_}/land", "2024-06-11")
    back = spark.read.json(f"{tmpdir_}/land")
    assert {(str(r.ds), r.cnt) for r in back.groupBy("ds").agg(F.count("*").alias("cnt")).collect()} == \
        {("2024-06-10", 1), ("2024-06-11", 2)}


def test_ticker_hash_over_landed_text(spark, tmpdir_):
    land_day(tmpdir_, "2024-06-10")
    from civicledger.plans.daily import text_schema
    raw = landing.read_landed(spark, f"{tmpdir_}/stock_tickers", text_schema(schemas.TICKERS))
    st = landing.extract_tickers(raw, "2024-06-10 06:00:00").where("ticker = 'LUMN'").first()
    import hashlib
    text = "true" + "" + "" + "usd" + "" + "2024-06-01T00:00:00Z" + "us" + "stocks" + "Lumen Lamps" + "LUMN"
    assert bytes(st.row_hash) == hashlib.sha256(text.encode()).digest()
    assert str(st.last_updated_utc).startswith("2024-06-01 00:00:00")


def test_error_policy_skips_bad_file(spark, tmpdir_):
    good = [price("AAA", "2024-06-10", 1, 2, 1, 2, 10) for _ in range(20)]
    mostly = [price("BBB", "2024-06-10", 1, 2, 1, 2, 10) for _ in range(9)] + \
        [dict(price("BBB", "2024-06-10", 1, 2, 1, 2, 10), **{"from": "not a date"})]
    one_bad = [price("CCC", "2024-06-10", 1, 2, 1, 2, 10) for _ in range(19)] + \
        [dict(price("CCC", "2024-06-10", 1, 2, 1, 2, 10), open="x")]
    write_array(f"{tmpdir_}/m/a_market_close.json.gz", good)
    write_array(f"{tmpdir_}/m/b_market_close.json.gz", mostly)          # 10 % bad: kept
    write_array(f"{tmpdir_}/m/c_market_close.json.gz", one_bad)         # 5 % bad: kept
    os.makedirs(f"{tmpdir_}/m", exist_ok=True)
    with gzip.open(f"{tmpdir_}/m/d_market_close.json.gz", "wt") as f:  # unparsable: ratio 1
        f.write("[{\"symbol\": \"DDD\", ")
    worse = [price("EEE", "2024-06-10", 1, 2, 1, 2, 10) for _ in range(4)] + \
        [dict(price("EEE", "2024-06-10", 1, 2, 1, 2, 10), volume="lots")]
    write_array(f"{tmpdir_}/m/e_market_close.json.gz", worse)           # 20 % bad: skipped
    recs, report = landing.read_with_error_policy(spark, f"{tmpdir_}/m", schemas.MARKET_PATHS)
    rows = landing.extract_market(recs)
    rep = {os.path.basename(r._file)[0]: (r.n_bad, r.skipped) for r in report.collect()}
    assert rep["a"] == (0, False) and rep["b"] == (1, False) and rep["c"] == (1, False)
    assert rep["d"][1] is True and rep["e"] == (1, True)
    assert sorted({r.symbol for r in rows.collect()}) == ["AAA", "BBB", "CCC"]
    assert rows.count() == 20 + 9 + 19


def test_pages_data_field_and_array_landing(spark, tmpdir_):
    p = f"{tmpdir_}/tpages/page0_government_trades.json.gz"
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with gzip.open(p, "wt") as f:
        json.dump({"data": [{"ticker": "X"}, {"ticker": "Y"}]}, f)
    got = landing.read_pages(spark, f"{tmpdir_}/tpages", schemas.TICKERS, "data")
    assert sorted(r.ticker for r in got.collect()) == ["X", "Y"]
    df = spark.createDataFrame([("A", 1), ("B", 2)], "t string, v int")
    landing.write_landing(df, f"{tmpdir_}/arr", "2024-06-10", layout="array")
    back = landing.read_landed(spark, f"{tmpdir_}/arr", df.schema, name_glob="*arr*")     # the default reader
    assert sorted(map(tuple, back.collect())) == [("A", 1), ("B", 2)]
    assert os.listdir(f"{tmpdir_}/arr") == ["ds=2024-06-10"]
    many = spark.range(50).selectExpr("cast(id as string) t", "cast(id as int) v")
    landing.write_landing(many, f"{tmpdir_}/arr", "2024-06-10", layout="array", rows_per_file=10)      # a re-run
    assert sorted(r.v for r in landing.read_landed(spark, f"{tmpdir_}/arr", df.schema).collect()) == list(range(50))
    assert len([n for n in os.listdir(f"{tmpdir_}/arr/ds=2024-06-10") if n.endswith(".json.gz")]) > 1


def test_a_file_of_any_size_passes_the_error_policy(spark, tmpdir_):
    """More than 128 MiB of records in one array: every row loads, both spellings included."""
    rows = [{"status": "OK", "from": "2024-06-03", "symbol": f"S{k}", "open": 1.5, "volume": 7079.6,
             ("afterHours" if k % 2 else "afterhours"): 2.5, "note": "x" * 1000} for k in range(150)]
    os.makedirs(f"{tmpdir_}/big")
    body = json.dumps(rows)[1:-1]
    with gzip.open(f"{tmpdir_}/big/2024_market_close.json.gz", "wt", compresslevel=1) as f:
        f.write("[" + ",".join([body] * 900) + "]")
    n = 150 * 900
    kept, report = landing.read_with_error_policy(spark, f"{tmpdir_}/big", schemas.MARKET_PATHS)
    assert [(r.n_rows, r.n_bad, r.skipped) for r in report.collect()] == [(n, 0, False)]
    got = landing.extract_market(kept)
    assert got.where("after_hours = 2.5 and stock_volume = 7080").count() == n
    typed = landing.extract_market_rows(landing.read_landed(
        landing.case_sensitive(spark), f"{tmpdir_}/big", schemas.MARKET_CLOSE))
    assert typed.where("after_hours = 2.5 and stock_volume = 7080").count() == n
