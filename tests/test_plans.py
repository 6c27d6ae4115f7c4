"""Plan checks: pruning reaches the scan, semi joins stay semi joins, no Python in any query."""

import os

import pytest

import __spark_entry__ as E
from civicledger.operators import keyed
from civicledger.plans import models as M
from civicledger.sources import landing, schemas
from civicledger.streaming.incremental import BATCH_COL, load_new_files
from fixtures import DAYS, land_day
from planutil import plan_text

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(E._queries.registered()))          # the library's own
def test_no_python_in_registered_queries(spark, name):
    plan = plan_text(E.queries()[name](spark, SF), "extended")
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                   "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in plan, f"{name}: {marker}"


def test_run_date_slice_prunes_partitions_and_columns(spark, tmpdir_):
    for d in DAYS[:2]:
        land_day(tmpdir_, d)
    table = f"{tmpdir_}/trades"
    load_new_files(spark, f"{tmpdir_}/government_trades", schemas.GOVERNMENT_TRADES, table,
                   f"{tmpdir_}/_ck", name_glob=landing.TRADES_GLOB, transform=landing.extract_trades,
                   partition_by=["report_date"])
    src = M.src_trades(spark.read.parquet(table).drop(BATCH_COL))
    plan = plan_text(M.official_trades(src, DAYS[0]))
    assert "PartitionFilters: [isnotnull(report_date" in plan and "= 2024-06-10" in plan
    scan = plan[plan.index("Scan parquet"):]
    read_schema = scan[scan.index("ReadSchema:"):].splitlines()[0]
    assert "disclosure_url" not in read_schema and "headshot" not in read_schema   # pruned columns
    assert "security_ticker" in read_schema


def test_semi_join_and_aggregate_shapes(spark):
    m = spark.createDataFrame([("A", 1)], "ticker string, date_recorded int")
    t = spark.createDataFrame([("A", 1)], "security_ticker string, transaction_date int")
    plan = plan_text(keyed.semi_join(m, t, [("ticker", "security_ticker"), ("date_recorded", "transaction_date")]))
    assert "LeftSemi" in plan and "HashAggregate" in plan         # right keys de-duplicated first
    df = spark.createDataFrame([("a", 1, "x")], "k string, u long, tb string")
    plan = plan_text(keyed.latest_per_key(df, "k", ["u"], ["tb"]))
    # one row per key leaves each map task: the limit stands below the exchange as well as above it
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1
