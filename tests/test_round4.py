"""Large contexts in fetch rounds and jobs: written once, read where they lie, results as before."""
import os

import pytest
from pyspark.sql import functions as F

from walletflow.operators import fetch as FE
from walletflow.operators.fetch import FetchOptions, fetch_rounds
from walletflow.plans import jobs
from walletflow.plans.stub_service import CyclingStubService
from walletflow.session import one_file_a_task

FAST = {"request_delay": 0.0, "backoff_429": 0.0, "round_delay": 0.0}
# hash text, which hardly gets smaller in a file
FILLER = "array_join(transform(sequence(1, 40), i -> sha2(concat(address, i), 256)), '')"


def large_documents(spark, n):
    rows = spark.range(n).select(F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("id")), 40, "0")).alias("address"))
    return rows.withColumn("doc", F.expr(f"""concat('{{"base":{{"note":"', {FILLER}, '"}}}}')"""))


def size_of(path):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(path) for f in files)


def due(n, rounds):
    """(round, attempted, failed) of the stub service for keys 0..n-1."""
    open_after = lambda r: sum(k % 12 >= r for k in range(n))
    return [(r, n if r == 1 else open_after(r - 1), open_after(r)) for r in range(1, rounds + 1)]


@pytest.mark.parametrize("how", [{}, {"calls_per_sec": 1e6}, {"no_retry": frozenset({"404"})}, {"max_partitions": 64}])
def test_large_contexts_are_staged_once(spark, tmp_dir, how):
    n, rounds = 240, 6
    opts = FetchOptions(**{"kind": "labels", "max_partitions": 2, "keys_per_partition": 40, "max_rounds": rounds, **FAST, **how})
    docs, landing = large_documents(spark, n), f"{tmp_dir}/l"
    run = fetch_rounds(docs, CyclingStubService(), opts, landing=landing, context="doc")
    assert run.round_counts == due(n, rounds)
    assert run.attempts().where("context is not null").isEmpty()  # each failure held its document
    assert os.listdir(f"{landing}/_pending/round=1").count("waves") == 1 and not os.path.exists(f"{landing}/_pending/round=2")
    once = size_of(f"{landing}/_pending/round=1/all")
    bodies = size_of(landing) - size_of(f"{landing}/_pending")
    # a copy in waves; of the documents, those that were answered: before, also every failure of every round
    assert size_of(f"{landing}/_pending") < 2.5 * once and bodies < 1.0 * once
    got = run.successes().join(docs, "address")
    assert got.count() == sum(k % 12 < rounds for k in range(n)) and got.where("body <> doc").isEmpty()
    assert run.dead_letters().count() == sum(k % 12 >= rounds for k in range(n))


def test_contexts_travel_where_a_wave_is_too_large_to_hold_its_failures(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(FE, "IN_PLACE_KEYS", 50)
    opts = FetchOptions(kind="labels", max_partitions=2, keys_per_partition=40, max_rounds=3, **FAST)
    run = fetch_rounds(large_documents(spark, 240), CyclingStubService(), opts, landing=f"{tmp_dir}/l", context="doc")
    assert run.round_counts == due(240, 3)
    assert {(r.ok, r.held) for r in run.attempts().select("ok", F.col("context").isNotNull().alias("held")).distinct().collect()} == {(True, False), (False, True)}


def test_jobs_over_contexts_in_place_hold_few_failed_keys(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(FE, "IN_PLACE_KEYS", 100)
    most, land = [], FE._land_waves
    monkeypatch.setattr(FE, "_land_waves", lambda *a, **b: most.append((a[3], len(a[5]))) or land(*a, **b))
    opts = FetchOptions(kind="labels", max_partitions=2, keys_per_partition=10, max_rounds=4, **FAST)
    run = fetch_rounds(large_documents(spark, 400), CyclingStubService(), opts, landing=f"{tmp_dir}/l", context="doc")
    assert run.round_counts == due(400, 4)
    held = {r: failed / 20 for r, _, failed in run.round_counts}  # failed keys a wave, of the 20 waves
    assert all(waves * held[r - 1] <= 100 or waves == 1 for r, waves in most if r > 1)
    assert max(waves for r, waves in most if r == 1) > 1


def test_a_lost_wave_over_contexts_in_place_is_fetched_again(spark, tmp_dir):
    docs, landing, asked = large_documents(spark, 240), f"{tmp_dir}/l", f"{tmp_dir}/asked"
    opts = FetchOptions(kind="labels", max_partitions=2, keys_per_partition=20, max_rounds=4, **FAST)
    service = CyclingStubService()
    run = fetch_rounds(docs, service, opts, landing=landing, context="doc")
    before = sorted(map(tuple, run.attempts().select("address", "round", "wave", "ok", "body").collect()))
    os.remove(f"{landing}/round=3/wave=2/_SUCCESS")

    def logged(req):
        assert req.context
        with open(asked, "a") as f:
            f.write(f"{req.address} {req.attempt}\n")
        return service(req)

    # the landing goes on as it was started, whatever the options are now
    other = FetchOptions(kind="labels", max_partitions=1, keys_per_partition=7, max_rounds=4, **FAST)
    again = fetch_rounds(docs, logged, other, landing=landing, context="doc")
    assert again.round_counts == run.round_counts
    assert sorted(map(tuple, again.attempts().select("address", "round", "wave", "ok", "body").collect())) == before
    assert sorted(open(asked).read().splitlines()) == sorted(f"{a} 3" for a, r, w, _, _ in before if (r, w) == (3, 2))


def test_a_key_without_address_keeps_failing_beside_large_contexts(spark, tmp_dir):
    docs = large_documents(spark, 24)
    docs = docs.unionByName(docs.limit(1).select(F.lit(None).cast("string").alias("address"), "doc"))
    run = fetch_rounds(docs, CyclingStubService(), FetchOptions(kind="labels", max_rounds=12, **FAST), landing=f"{tmp_dir}/l", context="doc")
    assert os.path.exists(f"{tmp_dir}/l/_pending/_in_place")
    assert run.round_counts == [(r, a + 1, f + 1) for r, a, f in due(24, 12)]
    assert [r["address"] for r in run.dead_letters().collect()] == [None]


def test_a_file_a_task(spark, tmp_dir):
    spark.range(60).repartition(12).write.parquet(f"{tmp_dir}/p")
    own = one_file_a_task(spark)
    assert own.read.parquet(f"{tmp_dir}/p").rdd.getNumPartitions() == 12
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get("spark.sql.files.openCostInBytes") != own.conf.get("spark.sql.files.openCostInBytes")


def test_pinned_keys_hold_a_document_once(spark, monkeypatch):
    monkeypatch.setattr(jobs, "AT_ONCE", 2)
    rows = [("0x01", "a")] * 5 + [("0x02", "b")] + [("0x03", "c")] * 4 + [(None, "d")] * 2
    pinned = jobs.pinned(spark.createDataFrame(rows, "address string, doc string"), "doc")
    assert pinned.count() == 4  # before, a document per row
    assert sorted(r["doc"] for r in pinned.collect()) == ["a", "b", "c", "d"]
    addresses = [r["address"] for r in jobs._every_row(pinned).collect()]
    assert sorted(addresses, key=str) == sorted((a for a, _ in rows), key=str)
    assert jobs.pinned(spark.createDataFrame([], "address string, doc string"), "doc").isEmpty()


def test_repeated_keys_come_back_in_the_export(spark, tmp_dir):
    from walletflow.schemas import PORTFOLIO_COLUMNS
    from walletflow.sinks.csv import read_csv

    token = '{"id":"t","name":"n","symbol":"S","balance":"1","price":"2","usd":"3"}'
    keys = [f"0x{k:040x}" for k in (0, 12, 12, 12, 1, 1, 23)]  # 23 fails eleven times
    docs = spark.createDataFrame([(a, '{"ethereum":{"t":%s}}' % token) for a in keys], "address string, doc string")
    path = jobs.export_portfolios(docs, CyclingStubService(), 0, FetchOptions(kind="portfolio", max_rounds=3, **FAST),
                                  context="doc", csv_dir=tmp_dir, filename="x")
    got = read_csv(spark, path, PORTFOLIO_COLUMNS).collect()
    assert sorted(r["address"] for r in got) == sorted(keys[:6])


def test_a_portfolio_job_writes_its_documents_a_few_times_only(spark, tmp_dir):
    token = """concat('{"id":"t","name":"', note, '","symbol":"S","balance":"1","price":"2","usd":"3"}')"""
    docs = large_documents(spark, 120).withColumn("note", F.expr(FILLER))
    docs = docs.select("address", F.expr(f"""concat('{{"ethereum":{{"t":', {token}, '}}}}')""").alias("doc"))
    twice = docs.unionByName(docs.limit(60))
    ns, landing = "round4_job", f"{tmp_dir}/l"
    opts = FetchOptions(kind="portfolio", max_partitions=2, keys_per_partition=20, max_rounds=10, **FAST)
    try:
        job = jobs.portfolio_job(spark, twice, CyclingStubService(), namespace=ns, name="p", as_of_ms=0, opts=opts, context="doc",
                                 table_root=f"{tmp_dir}/t", csv_dir=f"{tmp_dir}/csv", landing=landing)
        assert job.fetch.round_counts == due(120, 10)
        assert job.rows_written == job.load.rows_written == spark.table(f"{ns}.p").count() == 150  # 50 of the 60 that come twice
        # staged, once more in waves, those that were answered, and many small files
        assert size_of(landing) < 5 * size_of(f"{landing}/_pending/round=1/all")
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {ns} CASCADE")


def test_finished_shuffles_are_removed_after_a_large_step(spark, tmp_dir, monkeypatch):
    import time

    from walletflow import session

    def held():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        names = [blocks.apply(i).name() for i in range(blocks.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    before = held()
    spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_dir}/p")
    made = held() - before
    assert made
    session.release_shuffles(spark, f"{tmp_dir}/p")  # little was written: nothing is waited for
    monkeypatch.setattr(session, "RELEASE_BYTES", 1)
    session.release_shuffles(spark, f"{tmp_dir}/p")
    until = time.monotonic() + 10
    while made & held() and time.monotonic() < until:
        time.sleep(0.2)
    assert not made & held()
