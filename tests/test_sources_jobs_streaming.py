"""Sources, jobs and the streaming load."""

import os

from pyspark.sql import functions as F

from tests.test_labels import CORPUS
from walletflow.operators import labels as L
from walletflow.operators.fetch import FetchOptions, fetch_rounds
from walletflow.plans.jobs import JobStopped, label_job, portfolio_job
from walletflow.plans.stub_service import CyclingStubService
from walletflow.sources.landed import as_of, lookup
from walletflow.sources.results import column_values, extract_stats, latest_result

FAST = dict(request_delay=0.0, backoff_429=0.0, round_delay=0.0)


def test_label_valid_agrees_with_full_parse(spark):
    df = spark.createDataFrame([(str(i), b) for i, (b, _) in enumerate(CORPUS)], "address string, body string")
    got = L.parse_labels(df).select("address", "label_ok", L.label_valid(F.col("body")).alias("v")).collect()
    assert all(r["label_ok"] == r["v"] for r in got)


def test_latest_result_and_extraction(spark):
    res = spark.createDataFrame(
        [("2024-01-01", "a"), ("2024-01-02", "b"), ("2024-01-02", "b"), ("2024-01-02", None)],
        "run_ts string, user_addr string",
    ).withColumn("run_ts", F.to_timestamp("run_ts"))
    assert sorted(r["user_addr"] or "" for r in latest_result(res).collect()) == ["", "b", "b"]
    rows = spark.createDataFrame(
        [('{"user_addr":"x"}',), ('{"other":1}',), ('{"user_addr":null}',), ('{"user_addr":"x"}',)], "js string"
    )
    vals = [r["user_addr"] for r in column_values(rows, "user_addr", "js").collect()]
    assert sorted(v or "" for v in vals) == ["", "x", "x"]
    s = extract_stats(rows, "user_addr", "js").first()
    assert (s["total_rows"], s["values_extracted"], s["non_null_values"]) == (4, 3, 2)


def test_as_of_ties_and_future_versions(spark):
    hist = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 1, "a"), (1, "2024-01-02 00:00:00", 2, "b"), (1, "2024-01-02 00:00:00", 3, "c"),
         (1, "2024-01-09 00:00:00", 4, "future"), (2, "2024-01-09 00:00:00", 5, "only-future")],
        "key int, version_ts string, version_id int, body string",
    ).withColumn("version_ts", F.to_timestamp("version_ts"))
    got = {r["key"]: r["body"] for r in as_of(hist, F.to_timestamp(F.lit("2024-01-05 00:00:00"))).collect()}
    assert got == {1: "c"}


def test_lookup_keeps_unmatched_keys(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("b",)], "address string")
    landed = spark.createDataFrame([("b", "{}")], "address string, body string")
    got = sorted((r["address"], r["is_success"], r["error_message"]) for r in lookup(keys, landed, "none").collect())
    assert got == [("a", False, "none"), ("b", True, None), ("b", True, None)]


def _addr_df(spark, ks, doc):
    return spark.createDataFrame([(f"0x{k:040x}", doc) for k in ks], "address string, doc string")


def test_label_job_end_to_end_and_empty_keys(spark, tmp_dir):
    ns = "wf_test_jobs"
    keys = _addr_df(spark, [0, 1, 2, 10, 10], '{"ethereum":{"arkhamLabel":{"name":"L"},"isUserAddress":true}}')
    res = label_job(spark, keys, CyclingStubService(), namespace=ns, name="labels", run_date="2024-01-15",
                    opts=FetchOptions(kind="labels", max_rounds=3, **FAST), context="doc",
                    table_root=os.path.join(tmp_dir, "t"), dead_letter_path=os.path.join(tmp_dir, "dead"),
                    reject_path=os.path.join(tmp_dir, "rej"))
    dead = spark.read.parquet(os.path.join(tmp_dir, "dead")).collect()
    assert [(r["no"], r["attempts"], r["last_status"]) for r in dead] == [(1, 3, "400")]
    rows = spark.table(f"{ns}.labels").orderBy("no").collect()
    # keys 0, 1, 2 succeed in rounds 1, 2, 3; key 10 (twice) is a dead letter
    assert [r["no"] for r in rows] == [1, 2, 3]
    assert [r["address"].hex()[-2:] for r in rows] == ["00", "01", "02"]
    assert {r["label"] for r in rows} == {"L"} and all(r["isuseraddress"] for r in rows)
    assert res.fetch.dead_letters().count() == 1
    assert label_job(spark, keys.limit(0), CyclingStubService(), namespace=ns, name="labels",
                     opts=FetchOptions(kind="labels", **FAST), context="doc") is None


def test_empty_refresh_keeps_old_rows(spark, tmp_dir):
    ns = "wf_test_refresh"
    doc = '{"ethereum":{"t":{"id":"t","name":"n","symbol":"S","balance":"1","price":"2","usd":"2"}}}'
    root = os.path.join(tmp_dir, "p")
    portfolio_job(spark, _addr_df(spark, [0], doc), CyclingStubService(), namespace=ns, name="p",
                  opts=FetchOptions(kind="portfolio", **FAST), context="doc", table_root=root)
    assert spark.table(f"{ns}.p").count() == 1
    # every fetch fails now (key 11 never succeeds within 2 rounds): nothing to load
    res = portfolio_job(spark, _addr_df(spark, [11], doc), CyclingStubService(), namespace=ns, name="p",
                        opts=FetchOptions(kind="portfolio", max_rounds=2, **FAST), context="doc", table_root=root)
    assert res.rows_written == 0 and res.load is None
    assert spark.table(f"{ns}.p").count() == 1


def test_create_failure_stops_the_job(spark):
    keys = _addr_df(spark, [0], "{}")
    try:
        label_job(spark, keys, CyclingStubService(), namespace="bad name!", name="x",
                  opts=FetchOptions(kind="labels", **FAST))
    except JobStopped:
        return
    raise AssertionError("expected JobStopped")


def test_streaming_load_is_exactly_once(spark, tmp_dir):
    from walletflow.streaming.landing import load_landed_now

    keys = _addr_df(spark, range(24), '{"base":{"arkhamLabel":{"name":"B"}}}')
    run = fetch_rounds(keys, CyclingStubService(), FetchOptions(kind="labels", max_rounds=4, **FAST), context="doc")
    spark.sql("CREATE SCHEMA IF NOT EXISTS wf_test_stream")
    spark.sql(
        "CREATE TABLE wf_test_stream.t (round int, address string, name string, type string, website string, "
        "twitter string, crunchbase string, linkedin string, label string, isUserAddress boolean) USING parquet "
        f"LOCATION '{os.path.join(tmp_dir, 'st')}'"
    )
    ckpt = os.path.join(tmp_dir, "ckpt")
    load_landed_now(spark, run.landing, "labels", "wf_test_stream.t", ckpt)
    first = spark.table("wf_test_stream.t").count()
    load_landed_now(spark, run.landing, "labels", "wf_test_stream.t", ckpt)
    assert first == spark.table("wf_test_stream.t").count() == run.successes().count() == 8
