import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicledger.operators import keyed
from planutil import plan_text


def test_latest_null_ranks_first_and_tiebreak(spark):
    df = spark.createDataFrame([
        ("m1", 100, "t1"), ("m1", None, "t2"), ("m1", 300, "t3"),     # NULL ranks first
        ("m2", 200, "t4"), ("m2", 200, "t5"),                         # tie -> greatest tiebreak
        ("m3", 50, "t6"),
        (None, 1, "t7"), (None, 2, "t8"),                             # NULL key is one group
    ], "k string, u long, tb string")
    out = {r.k: (r.u, r.tb) for r in keyed.latest_per_key(df, "k", ["u"], ["tb"]).collect()}
    assert out == {"m1": (None, "t2"), "m2": (200, "t5"), "m3": (50, "t6"), None: (2, "t8")}


def test_latest_equals_row_number(spark):
    rnd = random.Random(7)
    data = [(f"k{rnd.randint(0, 30)}", rnd.choice([None, rnd.randint(0, 5)]), f"t{i:04d}")
            for i in range(500)]
    df = spark.createDataFrame(data, "k string, u long, tb string")
    w = Window.partitionBy("k").orderBy(F.col("u").desc_nulls_first(), F.col("tb").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    got = keyed.latest_per_key(df, "k", ["u"], ["tb"])
    assert sorted(map(tuple, ref.collect())) == sorted(map(tuple, got.collect()))


def test_collapse_duplicates_window(spark):
    d = dt.date
    rows = [
        ("OK", d(2024, 6, 1), "AAA", 1.0), ("OK", d(2024, 6, 1), "AAA", 1.0),   # recent dup -> 1
        ("OK", d(2024, 1, 1), "AAA", 1.0), ("OK", d(2024, 1, 1), "AAA", 1.0),   # 71+ days old -> kept
        ("OK", None, "AAA", 1.0), ("OK", None, "AAA", 1.0),                     # NULL date -> kept
        ("OK", d(2024, 6, 2), "BBB", 2.0),
    ]
    df = spark.createDataFrame(rows, "status string, date_recorded date, symbol string, close double")
    out = keyed.collapse_duplicates(df, "date_recorded", "2024-06-10")
    assert out.count() == 6
    rep = keyed.duplicate_report(df, "date_recorded", "2024-06-10").collect()
    assert len(rep) == 1 and rep[0].n_copies == 2 and rep[0].symbol == "AAA"


def test_collapse_window_boundary(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 4, 1), 1), (d(2024, 4, 1), 1), (d(2024, 3, 31), 1),
                                (d(2024, 3, 31), 1)], "date_recorded date, v int")
    # as_of 2024-06-10 minus 70 days = 2024-04-01: that day is inside the window
    assert keyed.collapse_duplicates(df, "date_recorded", "2024-06-10").count() == 3


def test_semi_join_keeps_left_duplicates_and_ignores_nulls(spark):
    left = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2), (None, 3)], "t string, d int")
    right = spark.createDataFrame([("A", 1), ("A", 1), (None, 3)], "rt string, rd int")
    out = keyed.semi_join(left, right, [("t", "rt"), ("d", "rd")])
    assert sorted(map(tuple, out.collect())) == [("A", 1), ("A", 1)]
    assert "LeftSemi" in plan_text(out)


def test_collapse_treats_null_as_blank_like_the_source(spark):
    d = dt.date(2024, 6, 1)
    df = spark.createDataFrame([("", d, "AAA"), ("", d, "AAA"), (None, d, "AAA"),   # '' group eats NULL row
                                (None, d, "BBB"), (None, d, "BBB"),                 # NULL group
                                ("x", d, "CCC")], "status string, date_recorded date, symbol string")
    out = sorted(map(tuple, keyed.collapse_duplicates(df, "date_recorded", "2024-06-10").collect()), key=str)
    assert out == sorted([("", d, "AAA"), (None, d, "BBB"), ("x", d, "CCC")], key=str)
