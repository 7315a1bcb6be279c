"""Fetch rounds with deterministic stub services."""

import os

from pyspark.sql import functions as F

from walletflow.operators.fetch import FetchOptions, attach_keys, fetch_rounds
from walletflow.plans.stub_service import CyclingStubService

FAST = dict(request_delay=0.0, backoff_429=0.0, round_delay=0.0)


class LoggingService:
    """Answers '{}' and appends one line per call to a log file."""

    def __init__(self, log, fail_first=0):
        self.log = log
        self.fail_first = fail_first

    def __call__(self, req):
        with open(self.log, "a") as fh:
            fh.write(f"{req.address} {req.attempt}\n")
        if req.attempt <= self.fail_first:
            return 500, None
        return 200, "{}"


def _keys(spark, n, dup=0):
    rows = [(f"0x{i:040x}",) for i in range(n)] + [(f"0x{0:040x}",)] * dup
    return spark.createDataFrame(rows, "address string")


def test_each_key_fetched_once_per_round_and_never_again(spark, tmp_dir):
    log = os.path.join(tmp_dir, "calls.log")
    run = fetch_rounds(_keys(spark, 50, dup=5), LoggingService(log, fail_first=2),
                       FetchOptions(kind="labels", **FAST))
    assert run.rounds == 3
    calls = open(log).read().splitlines()
    assert len(calls) == 150 and len(set(calls)) == 150  # distinct keys only, once per round
    # reading results again does not call the service
    run.successes().count()
    run.attempts().collect()
    run.dead_letters().count()
    assert len(open(log).read().splitlines()) == 150


def test_early_stop_and_duplicates(spark, tmp_dir):
    keys = _keys(spark, 20, dup=3)
    run = fetch_rounds(keys, LoggingService(os.path.join(tmp_dir, "l")), FetchOptions(kind="labels", **FAST))
    assert run.rounds == 1
    assert run.dead_letters().count() == 0
    joined = attach_keys(keys, run.successes().select("address", "body"))
    assert joined.count() == 23


def test_cycling_stub_dead_letters_and_statuses(spark):
    keys = spark.range(0, 48).select(
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("id")), 40, "0")).alias("address"),
        F.lit("{}").alias("doc"),
    )
    run = fetch_rounds(keys, CyclingStubService(), FetchOptions(kind="labels", **FAST), context="doc")
    assert run.rounds == 10
    assert [c[2] for c in run.round_counts] == [44, 40, 36, 32, 28, 24, 20, 16, 12, 8]
    dead = {r["address"]: r for r in run.dead_letters().collect()}
    assert len(dead) == 8
    assert {r["last_status"] for r in dead.values()} == {"401"}
    statuses = {r["status"] for r in run.attempts().select("status").distinct().collect()}
    assert statuses == {"200", "429", "500", "400", "401", "timeout", "connection_error"}


def test_bad_document_with_200_is_retried(spark, tmp_dir):
    class Flaky:
        def __call__(self, req):
            return 200, ("[1]" if req.attempt == 1 else "{}")

    run = fetch_rounds(_keys(spark, 5), Flaky(), FetchOptions(kind="portfolio", **FAST))
    assert run.rounds == 2
    first = run.attempts().filter("round = 1").select("status").distinct().collect()
    assert [r["status"] for r in first] == ["invalid_document"]


def test_no_retry_statuses_stop(spark):
    class Unauthorized:
        def __call__(self, req):
            return 401, None

    run = fetch_rounds(_keys(spark, 4), Unauthorized(),
                       FetchOptions(kind="labels", no_retry=frozenset({"401"}), **FAST))
    assert run.rounds == 1


def test_null_key_ends_as_dead_letter(spark):
    keys = spark.createDataFrame([(None, "{}"), ("0x" + "0" * 40, "{}")], "address string, doc string")
    run = fetch_rounds(keys, CyclingStubService(), FetchOptions(kind="labels", max_rounds=3, **FAST), context="doc")
    dead = run.dead_letters().collect()
    assert [r["address"] for r in dead] == [None]
    assert dead[0]["last_status"] == "error"


def test_large_rounds_run_in_waves_and_resume(spark, tmp_dir):
    log = os.path.join(tmp_dir, "calls.log")
    landing = os.path.join(tmp_dir, "landing")
    opts = FetchOptions(kind="labels", max_partitions=2, keys_per_partition=5, **FAST)
    run = fetch_rounds(_keys(spark, 47), LoggingService(log, fail_first=1), opts, landing=landing)
    assert run.rounds == 2 and run.round_counts == [(1, 47, 47), (2, 47, 0)]
    waves = sorted(os.listdir(os.path.join(landing, "round=1")))
    assert len([w for w in waves if w.startswith("wave=")]) == 5  # ceil(47 / (2 x 5))
    calls = open(log).read().splitlines()
    assert len(calls) == 94 and len(set(calls)) == 94
    # a rerun over the same landing folder fetches nothing again
    again = fetch_rounds(_keys(spark, 47), LoggingService(log, fail_first=1), opts, landing=landing)
    assert again.round_counts == run.round_counts
    assert len(open(log).read().splitlines()) == 94
    assert again.successes().count() == 47


def test_success_plus_dead_letters_is_the_input_for_any_partitioning(spark):
    import random

    rng = random.Random(7)
    ks = rng.sample(range(10_000), 120)
    keys = spark.createDataFrame([(f"0x{k:040x}", "{}") for k in ks + ks[:10]], "address string, doc string")
    results = []
    for parts, per in ((1, 1000), (4, 7), (16, 3)):
        run = fetch_rounds(keys, CyclingStubService(),
                           FetchOptions(kind="labels", max_rounds=6, max_partitions=parts, keys_per_partition=per, **FAST),
                           context="doc")
        ok = {r["address"] for r in run.successes().select("address").collect()}
        dead = {r["address"] for r in run.dead_letters().select("address").collect()}
        assert not ok & dead
        assert ok | dead == {f"0x{k:040x}" for k in ks}
        assert ok == {f"0x{k:040x}" for k in ks if k % 12 < 6}
        results.append(sorted(run.round_counts))
    assert results[0] == results[1] == results[2]


def test_export_calls(spark, tmp_dir):
    from walletflow.plans.jobs import export_labels, export_portfolios

    keys = spark.createDataFrame([(f"0x{k:040x}", "{}") for k in (0, 12, 24)], "address string, doc string")
    path = export_labels(keys, CyclingStubService(), FetchOptions(kind="labels", **FAST), context="doc",
                         csv_dir=tmp_dir, filename="whales")
    assert path.endswith("/whales.csv") and os.path.isdir(path)
    assert export_portfolios(keys, CyclingStubService(), 0, FetchOptions(kind="portfolio", **FAST), context="doc",
                             csv_dir=tmp_dir) is None  # '{}' portfolios have no token rows
    assert export_labels(keys.limit(0), CyclingStubService()) is None


def test_empty_key_set(spark):
    run = fetch_rounds(_keys(spark, 0), CyclingStubService(), FetchOptions(kind="labels", **FAST))
    assert run.rounds == 0
    assert run.successes().count() == 0 and run.dead_letters().count() == 0
