"""Physical-plan properties the design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from walletflow.operators.fetch import FetchOptions, attach_keys, fetch_rounds
from walletflow.operators.numbering import dense_number
from walletflow.operators.stats import batch_summary
from walletflow.plans.stub_service import CyclingStubService

QUERIES = entry.queries()

PLAN_ONLY = [
    "portfolio_flat", "portfolio_valid", "portfolio_ordered", "portfolio_chain_filter", "portfolio_paged",
    "label_flat", "label_entity", "label_record", "label_chains", "label_lookup",
    "portfolio_asof", "latest_result", "column_values", "extract_stats", "address_binary", "endpoint_key",
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_no_cartesian_and_no_row_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["portfolio_flat", "label_flat", "portfolio_valid"])
def test_flatten_is_narrow(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "Exchange" not in plan, plan


def test_as_of_filter_reaches_the_scan(spark):
    plan = _plan(QUERIES["portfolio_asof"](spark, SF_SMALL))
    assert "LessThanOrEqual(ts" in plan


def test_latest_run_is_a_partition_filter(spark):
    plan = _plan(QUERIES["latest_result"](spark, SF_SMALL))
    assert "Join" not in plan
    assert any("PartitionFilters" in line and "ubquery" in line for line in plan.splitlines())


def test_hot_key_is_fetched_once_and_joined_back(spark):
    hot = "0x" + "0" * 40
    n_cold = 400
    keys = spark.range(0, n_cold).select(
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.col("id") * 12)), 40, "0")).alias("address")
    ).unionByName(spark.range(0, n_cold // 2).select(F.lit(hot).alias("address")))
    keys = keys.withColumn("doc", F.lit("{}"))
    run = fetch_rounds(keys, CyclingStubService(),
                       FetchOptions(kind="labels", request_delay=0, backoff_429=0, round_delay=0), context="doc")
    assert run.round_counts[0][1] == n_cold  # distinct keys only (the hot key is one of them)
    joined = attach_keys(keys.select("address"), run.successes().select("address", "round"))
    assert joined.count() == n_cold + n_cold // 2
    s = batch_summary(keys.select("address"), run.successes()).first()
    assert (s["total"], s["succeeded"]) == (n_cold + n_cold // 2, n_cold + n_cold // 2)


def test_numbering_splits_a_hot_value_with_a_tie_breaker(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("pos"),
    )
    out = dense_number(df, ["k", "pos"], "no", partitions=6)
    sizes = [r["c"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).collect()]
    assert sorted(r["no"] for r in out.collect()) == list(range(1, 3001))
    assert max(sizes) < 1000  # the hot value is spread over several partitions
