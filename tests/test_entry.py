"""The driver contract: entry() runs, every query has an oracle, and each equals it (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, coarse_duck, coarse_spark, digest

SF = "/root/testdata/sf0.001"
#: The library's own queries; those of the optional subpackage have their own tests.
LIBRARY = sorted(E._queries.registered())
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 27


def test_every_query_has_an_oracle():
    assert set(LIBRARY) <= set(E.queries())
    assert set(LIBRARY) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", LIBRARY)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert {f.name: coarse_spark(f.dataType.simpleString()) for f in df.schema.fields} == \
        {c: coarse_duck(str(t)) for c, t in zip(rel.columns, rel.types)}
    assert digest(srows, df.columns) == digest(drows, rel.columns)


@pytest.mark.parametrize("name", ["src_trades", "epoch_to_ts", "officials_current", "scd2_apply"])
def test_queries_do_not_depend_on_session_time_zone(spark, duck, name):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF)
        assert spark.conf.get(key) == "America/Los_Angeles"       # caller's setting left as it was
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set(key, before)
    rel = duck.sql(E.oracle_sql()[name])
    assert digest(srows, df.columns) == digest(rel.fetchall(), rel.columns)
