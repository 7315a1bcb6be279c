"""Fetch rounds and documents on larger tables: shape of the work, results as before."""
import os

from pyspark.sql import functions as F

from walletflow.operators import fetch as FE
from walletflow.operators.fetch import FetchOptions, FetchRequest, fetch_rounds
from walletflow.plans.stub_service import CyclingStubService

FAST = {"request_delay": 0.0, "backoff_429": 0.0, "round_delay": 0.0}


def keys(spark, n):
    return spark.range(n).select(F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("id")), 40, "0")).alias("address"), F.lit("{}").alias("doc"))


def test_one_wave_of_many_keys_is_spread_over_the_cores(spark, tmp_dir):
    opts = FetchOptions(kind="labels", keys_per_partition=1_000_000, max_rounds=2, **FAST)
    run = fetch_rounds(keys(spark, 4500), CyclingStubService(), opts, landing=f"{tmp_dir}/l", context="doc")
    files = [f for f in os.listdir(f"{tmp_dir}/l/round=1/wave=0") if f.startswith("part-")]
    assert len(files) == min(3, spark.sparkContext.defaultParallelism)
    assert [c[:2] for c in run.round_counts] == [(1, 4500), (2, 4125)]
    assert FE._tasks(spark, 4500, FetchOptions(max_partitions=2, keys_per_partition=1_000_000)) <= 2
    assert FE._tasks(spark, 4500, FetchOptions(keys_per_partition=100)) == 45


def test_calls_are_handed_on_in_large_batches_in_order(spark, monkeypatch):
    import pandas as pd

    pdf = pd.DataFrame({"address": [f"0x{k:040x}" for k in range(5000)], "context": ["x" * 10] * 5000})
    answer = lambda req: (200, req.context)
    out = list(FE._fetch_partitions(answer, 1, FetchOptions(**FAST))([pdf]))
    assert [len(o) for o in out] == [2000, 2000, 1000]
    assert [a for o in out for a in o["address"]] == pdf["address"].tolist()
    monkeypatch.setattr(FE, "BATCH_CHARS", 100)  # long bodies: smaller batches, no call lost
    out = list(FE._fetch_partitions(answer, 1, FetchOptions(**FAST))([pdf[:200]]))
    assert max(map(len, out)) <= 10 + FetchOptions().threads
    assert [a for o in out for a in o["address"]] == pdf["address"][:200].tolist()


def test_no_file_of_a_staged_wave_holds_the_whole_wave(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(FE, "STAGED_KEYS", 50)
    opts = FetchOptions(kind="labels", max_partitions=4, keys_per_partition=100, max_rounds=1, **FAST)
    run = fetch_rounds(keys(spark, 800), CyclingStubService(), opts, landing=f"{tmp_dir}/l", context="doc")
    staged = spark.read.parquet(f"{tmp_dir}/l/_pending/round=1/waves")
    assert staged.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < 200
    assert staged.select("address").distinct().count() == run.attempts().select("address").distinct().count() == 800
    # the document is kept for the keys that are tried again
    assert {(r.ok, r.held) for r in run.attempts().select("ok", F.col("context").isNotNull().alias("held")).distinct().collect()} == {(True, False), (False, True)}


def test_every_file_of_a_staged_wave_has_a_task_of_its_own(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(FE, "STAGED_KEYS", 50)
    opts = FetchOptions(kind="labels", max_rounds=1, max_partitions=1, keys_per_partition=400, **FAST)
    fetch_rounds(keys(spark, 1200), CyclingStubService(), opts, landing=f"{tmp_dir}/l")
    staged = spark.read.parquet(f"{tmp_dir}/l/_pending/round=1/waves")
    files = staged.groupBy("wave", F.input_file_name().alias("file")).agg(F.count("*").alias("n")).collect()
    assert len({r["wave"] for r in files}) == 3 and sum(r["n"] for r in files) == 1200
    assert max(r["n"] for r in files) < 90  # hashed file numbers met in one task, two or three files' keys in each


def test_large_contexts_make_more_files_of_a_staged_wave(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(FE, "STAGED_BYTES", 64 << 10, raising=False)
    docs = keys(spark, 300).withColumn("doc", F.expr("array_join(transform(sequence(1, 40), i -> sha2(concat(address, i), 256)), '')"))
    opts = FetchOptions(kind="labels", max_rounds=1, max_partitions=1, keys_per_partition=100, **FAST)
    fetch_rounds(docs, CyclingStubService(), opts, landing=f"{tmp_dir}/l", context="doc")
    staged = spark.read.parquet(f"{tmp_dir}/l/_pending/round=1/waves")
    files = staged.groupBy(F.input_file_name().alias("file")).agg(F.sum(F.length("context")).alias("chars")).collect()
    assert sum(r["chars"] for r in files) == 300 * 40 * 64
    assert max(r["chars"] for r in files) < 4 * (64 << 10)  # a wave of 256,000 was one file


def test_documents_of_repeated_and_missing_keys(spark, tmp_dir):
    import json

    from walletflow.plans import fixtures as fx

    spark.createDataFrame([(1, 10, "2-HIGH"), (2, 10, "2-HIGH"), (3, 11, "other"), (4, None, "5-LOW"), (4, 12, "5-LOW")],
                          "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(1, 7, 1.0, 10.5), (2, 7, 2.0, 20.0), (1, 8, 1.0, 1.0), (3, 7, 1.0, 1.0), (4, 7, 3.0, 4.0), (None, 7, 1.0, 1.0), (1, 99, 1.0, 1.0)],
                          "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(7, 'a "b"', 5.0), (7, "a2", 6.0), (8, None, None)], "p_partkey long, p_name string, p_retailprice double").write.parquet(f"{tmp_dir}/part.parquet")
    docs = fx.portfolio_documents(spark, tmp_dir)
    got = {r.k: r for r in docs.collect()}
    assert set(got) == {10, 11, 12, None} and got[10].address == "0x" + "0" * 39 + "a" and got[None].address is None
    seven = '"7":{"id":"7","name":"%s","symbol":"%s","balance":"3.00","price":"%s","usd":"30.50"}'
    assert got[10].body == '{"arbitrum_one":{' + seven % ('a \\"b\\"', 'a \\"b\\"', "5.00") + "," + seven % ("a2", "a2", "6.00") + ',"8":{"id":"8","balance":"1.00","usd":"1.00"}}}'
    assert got[11].body == "{}" and json.loads(got[12].body)["polygon"]["7"]["balance"] == "3.00"
    # orders and lineitem, part names, rows by part, rows by customer; the sums need no exchange of their own
    plan = fx.portfolio_documents(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 5 and plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def test_documents_are_parsed_once(spark):
    from walletflow.operators import labels as L
    from walletflow.operators import portfolio as P

    docs = spark.createDataFrame([("a", "{}")], "address string, body string")
    # the strict parse of a portfolio gets no text where the typed one was enough
    for rows, parses in ((P.portfolio_rows(docs), 2), (L.flatten_labels(L.parse_labels(docs)), 1)):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == parses


def test_numbers_first_in_a_text_are_marked(spark):
    from walletflow.functions.jsonmap import NUMBER_MARK, with_marked_numbers

    texts = ["5", " \n-5", "[1", '{"a":1}', '{"a": "x", "b": [ 2,3]}', '{"a":"x: 1"}', "{}"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "b string").select(with_marked_numbers(F.col("b"))).collect()]
    mark = lambda n: f'"{NUMBER_MARK}{n}"'
    assert got == [mark(5), " \n" + mark(-5), "[" + mark(1), '{"a":%s}' % mark(1), '{"a": "x", "b": [ %s,%s]}' % (mark(2), mark(3)), '{"a":"x: 1"}', "{}"]


def test_one_small_file_is_built_into_documents_by_many_tasks(spark, tmp_dir):
    from walletflow.plans import fixtures as fx

    spark.range(2000).select(
        (F.col("id") + 1).alias("c_custkey"), F.lit("n").alias("c_name"), F.lit(0).alias("c_nationkey"), F.lit("S").alias("c_mktsegment")
    ).coalesce(1).write.parquet(f"{tmp_dir}/customer.parquet")
    spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string").write.parquet(f"{tmp_dir}/nation.parquet")
    docs = fx.label_documents(spark, tmp_dir)
    docs.write.parquet(f"{tmp_dir}/docs")
    files = [f for f in os.listdir(f"{tmp_dir}/docs") if f.startswith("part-")]
    assert len(files) >= 2 * spark.sparkContext.defaultParallelism
    assert spark.read.parquet(f"{tmp_dir}/docs").select("k").distinct().count() == 2000


def test_pages_are_built_on_the_exchange_that_counts_them(spark, tmp_dir):
    from walletflow.plans import fixtures as fx

    spark.createDataFrame([(1, 10, "2-HIGH"), (2, 10, "2-HIGH"), (3, 11, "other"), (4, None, "5-LOW"), (4, 12, "5-LOW")],
                          "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(1, p, 1.0, 10.5) for p in range(1, 10)] + [(2, 7, 2.0, 20.0), (3, 7, 1.0, 1.0), (4, 7, 3.0, 4.0), (None, 7, 1.0, 1.0)],
                          "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(p, f"n{p}", 5.0) for p in range(1, 10)] + [(7, "a2", 6.0)], "p_partkey long, p_name string, p_retailprice double").write.parquet(f"{tmp_dir}/part.parquet")
    pages = fx.portfolio_pages(spark, tmp_dir, 3)
    got = pages.collect()
    assert {(r.k, r.network) for r in got} == {(10, "arbitrum_one"), (12, "polygon")}  # neither null keys nor unknown networks
    assert len([r for r in got if r.k == 10]) <= 4 and sum(r.body.count('"id"') for r in got) == 10 + 2
    assert '"7":{"id":"7","name":"a2","symbol":"a2","balance":"3.00","price":"6.00","usd":"4.00"}' in next(r.body for r in got if r.k == 12)
    plan = fx.portfolio_pages(spark, tmp_dir, 3)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_audited_loads_read_rows_that_are_parsed_once(spark, monkeypatch):
    from walletflow.plans.queries import QUERIES
    from walletflow.sinks import tables

    plans, load = [], tables.load_rows

    def seen(spark, rows, *args, **kwargs):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return load(spark, rows, *args, **kwargs)

    monkeypatch.setattr(tables, "load_rows", seen)
    assert QUERIES["audited_refresh"](spark, "/root/testdata/sf0.001").count() == 5
    assert len(plans) == 5 and not any("from_json" in p for p in plans)


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_short_waves_share_jobs_and_land_one_by_one(spark, tmp_dir):
    opts = FetchOptions(kind="labels", max_partitions=2, keys_per_partition=5, max_rounds=2, **FAST)
    service = CyclingStubService()
    run, jobs = jobs_of(spark, "waves", lambda: fetch_rounds(keys(spark, 400), service, opts, landing=f"{tmp_dir}/l", context="doc"))
    assert run.round_counts == [(1, 400, 366), (2, 366, 332)]
    assert jobs < 40  # 40 waves and 37 waves
    landed = f"{tmp_dir}/l/round=1"
    waves = [w for w in os.listdir(landed) if w.startswith("wave=")]
    assert len(waves) == len(os.listdir(f"{tmp_dir}/l/_pending/round=1/waves")) - sum(n.startswith(("_", ".")) for n in os.listdir(f"{tmp_dir}/l/_pending/round=1/waves"))
    assert all(os.path.exists(f"{landed}/{w}/_SUCCESS") for w in waves)
    assert all(sum(f.startswith("part-") for f in os.listdir(f"{landed}/{w}")) <= 2 for w in waves)
    # a wave whose job died is fetched again, the others are not
    os.remove(f"{landed}/{waves[3]}/_SUCCESS")
    os.remove(f"{landed}/{waves[7]}/_SUCCESS")
    asked = f"{tmp_dir}/asked"

    def logged(req):
        with open(asked, "a") as f:
            f.write(f"{req.address} {req.attempt}\n")
        return service(req)

    again = fetch_rounds(keys(spark, 400), logged, opts, landing=f"{tmp_dir}/l", context="doc")
    assert again.round_counts == run.round_counts
    attempts = again.attempts()
    assert attempts.count() == attempts.select("address", "round").distinct().count() == 766
    lost = attempts.where(F.concat(F.lit("wave="), F.col("wave").cast("string")).isin(waves[3], waves[7]) & (F.col("round") == 1))
    assert sorted(open(asked).read().splitlines()) == sorted(f"{r.address} 1" for r in lost.collect())


def test_waves_are_dealt_to_the_allowed_tasks(spark):
    rows = keys(spark, 300).withColumn("wave", (F.conv(F.substring("address", 3, 40), 16, 10).cast("int") % 20) + 5)
    for n, parts, tasks in ((20, 4, 4), (20, 64, 60), (20, 20, 20)):
        dealt = FE._dealt(rows, 5, n, parts)
        assert dealt.rdd.getNumPartitions() == tasks
        assert dealt.count() == 300
        assert dealt.select("wave", F.spark_partition_id().alias("t")).distinct().groupBy("wave").count().agg(F.max("count")).first()[0] <= max(1, parts // n)
