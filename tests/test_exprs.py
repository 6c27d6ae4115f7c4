import datetime as dt
from decimal import Decimal

from civicledger.functions import exprs as X


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_dollar_bounds_and_midpoint(spark):
    df = spark.createDataFrame(
        [("$1,001 - $15,000",), ("Over $50,000,000",), ("",), (None,), ("$15,001 - $50,000",)],
        "amount string")
    lo, hi = X.dollar_bound("amount", 1), X.dollar_bound("amount", 2)
    out = rows(df.select("amount", lo, hi, X.range_midpoint(lo, hi)))
    assert out[0][1:] == (1001, 15000, 8001)           # 8000.5 rounds away from zero
    assert out[1][1:] == (50000000, None, None)
    assert out[2][1:] == (None, None, None)
    assert out[3][1:] == (None, None, None)
    assert out[4][1:] == (15001, 50000, 32501)


def test_midpoint_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(-2, -3), (1, 2), (0, 0)], "lo long, hi long")
    assert [r[0] for r in df.select(X.range_midpoint("lo", "hi")).collect()] == [-3, 2, 0]


def test_blank_to_null_keeps_whitespace(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("AAPL",)], "t string")
    assert [r[0] for r in df.select(X.blank_to_null("t")).collect()] == [None, " ", None, "AAPL"]
    assert [r[0] for r in df.select(X.non_empty("t")).collect()] == [False, True, None, True]


def test_trade_type_decode_and_flags(spark):
    df = spark.createDataFrame([("P",), ("S",), ("S (Partial)",), ("E",), (None,)], "t string")
    out = rows(df.select(X.decode_trade_type("t"), X.is_purchase("t"), X.is_sale("t")))
    assert out == [("Purchase", 1, 0), ("Sale", 0, 1), ("Partial Sale", 0, 1),
                   ("UNKNOWN", 0, 0), ("UNKNOWN", 0, 0)]


def test_party_and_chamber(spark):
    df = spark.createDataFrame([("R", "House"), ("D", "Senate"), ("I", "Other"), (None, None)],
                               "p string, c string")
    out = rows(df.select(X.decode_party("p"), X.decode_chamber("c")))
    assert out == [("Republican", "House of Representatives"), ("Democrat", "Senate"),
                   ("UNKNOWN", "UNKNOWN"), ("UNKNOWN", "UNKNOWN")]


def test_epoch_to_ts_and_monday(spark):
    df = spark.createDataFrame([(1734012102, dt.date(2024, 12, 12)), (0, dt.date(2024, 12, 9))],
                               "e long, d date")
    out = rows(df.select(X.epoch_to_ts("e").cast("timestamp_ntz"), X.closest_past_monday("d")))
    assert out[0] == (dt.datetime(2024, 12, 12, 14, 1, 42), dt.date(2024, 12, 9))
    assert out[1] == (dt.datetime(1970, 1, 1), dt.date(2024, 12, 9))      # Monday maps to itself


def test_row_hash_collision_is_documented(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc")], "a string, b string")
    hs = [r[0] for r in df.select(X.row_hash_hex("a", "b")).collect()]
    assert hs[0] == hs[1] == hs[2]
    import hashlib
    assert hs[0] == hashlib.sha256(b"abc").hexdigest()
    raw = df.select(X.row_hash("a", "b")).first()[0]
    assert bytes(raw).hex() == hs[0]


def test_whole_long_rounds(spark):
    df = spark.createDataFrame([(7079.6,), (7079.4,), (None,)], "v double")
    assert [r[0] for r in df.select(X.to_whole_long("v")).collect()] == [7080, 7079, None]


def test_price_midpoint_decimal(spark):
    df = spark.createDataFrame([(Decimal("10.5000"), Decimal("9.4999"))], "h decimal(20,4), l decimal(20,4)")
    assert df.select(X.price_midpoint("h", "l")).first()[0] == Decimal("10")


def test_no_python_udf_in_expressions(spark):
    df = spark.createDataFrame([("$1,001 - $15,000", "P", 1734012102)], "a string, t string, e long")
    from planutil import plan_text
    plan = plan_text(df.select(X.dollar_bound("a", 1), X.decode_trade_type("t"), X.epoch_to_ts("e"),
                               X.row_hash("a", "t")))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
