"""Resume, strict JSON, partitioned tables, rejects, reruns."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_fetch import FAST, LoggingService, _keys
from walletflow.operators import labels as L
from walletflow.operators import portfolio as P
from walletflow.operators.fetch import FetchOptions, fetch_rounds
from walletflow.plans import jobs
from walletflow.sinks import tables
from walletflow.sinks.csv import read_csv, write_csv
from walletflow.sources.results import column_values, extract_stats, latest_result


def _counts(run):
    return run.successes().count(), run.dead_letters().count()


def test_resume_with_other_partition_size_keeps_all_keys(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    keys = _keys(spark, 20)
    first = f"{landing}/_pending/round=1"
    keys.select("address", F.lit(None).cast("string").alias("context")).write.parquet(f"{first}/all")
    spark.read.parquet(f"{first}/all").withColumn("wave", F.pmod(F.xxhash64("address"), F.lit(4))).write.partitionBy("wave").parquet(f"{first}/waves")
    opts = FetchOptions(kind="labels", max_partitions=1, keys_per_partition=10, **FAST)
    run = fetch_rounds(keys, LoggingService(os.path.join(tmp_dir, "l")), opts, landing=landing)
    assert _counts(run) == (20, 0)


def test_resume_of_one_wave_with_smaller_partitions(spark, tmp_dir):
    landing, log = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "l")
    fetch_rounds(_keys(spark, 20), LoggingService(log), FetchOptions(kind="labels", **FAST), landing=landing)
    small = FetchOptions(kind="labels", max_partitions=1, keys_per_partition=3, **FAST)
    run = fetch_rounds(_keys(spark, 20), LoggingService(log), small, landing=landing)
    assert _counts(run) == (20, 0) and len(open(log).read().splitlines()) == 20


def test_waves_without_keys(spark, tmp_dir):
    landing, log = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "l")
    opts = FetchOptions(kind="labels", max_partitions=1, keys_per_partition=1, **FAST)
    for _ in range(2):
        run = fetch_rounds(_keys(spark, 8), LoggingService(log), opts, landing=landing)
        assert _counts(run) == (8, 0) and len(open(log).read().splitlines()) == 8
    assert len(os.listdir(f"{landing}/round=1")) < 8  # some wave got no key


def test_used_landing_refuses_other_keys_or_as_of(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    service = LoggingService(os.path.join(tmp_dir, "l"))
    fetch_rounds(_keys(spark, 5), service, FetchOptions(kind="portfolio", as_of_ms=1, **FAST), landing=landing)
    for keys, opts in ((_keys(spark, 6), FetchOptions(kind="portfolio", as_of_ms=1, **FAST)), (_keys(spark, 5), FetchOptions(kind="portfolio", as_of_ms=2, **FAST))):
        with pytest.raises(ValueError, match="another run"):
            fetch_rounds(keys, service, opts, landing=landing)


def test_no_retry_keys_are_dead_letters(spark):
    class Refuses:
        def __call__(self, req):
            return (401, None) if int(req.address, 16) < 10 else (200, "{}")

    run = fetch_rounds(_keys(spark, 30), Refuses(), FetchOptions(kind="labels", no_retry=frozenset({"401"}), **FAST))
    dead = run.dead_letters().collect()
    assert run.successes().count() == 20 and {(r.attempts, r.last_status) for r in dead} == {(1, "401")}
    assert sorted(r.no for r in dead) == list(range(1, 11))


TOKEN = {"symbol": "A", "balance": 1, "price": 2, "usd": 3}
BODIES = [
    "{}", '{"ethereum":{}}', "{'ethereum':{}}", '{"ethereum":{}} trailing', '{"ethereum":{}}{"base":{}}', '{"ethereum":{}}]', '{"ethereum":{}}}',
    '{"ethereum":{}', "[]", "[{}]", "null", "1", '"x"', "", " ", ' \n{"ethereum":{}}\t ', '{"ethereum":{}},"x":{}', '{"ethereum":{}},"d":{}',
    '{"ethereum":{}},', '{"a":{},}', "{a:{}}", '{"a":NaN}', '{"a":01}', '{"a":{},"a":{}}', '{"a":"x\ty"}', '{"a":{}} // c',
]


def _python_object(body):
    try:
        return isinstance(json.loads(body), dict)
    except ValueError:
        return False


def test_only_whole_json_objects_are_accepted(spark):
    df = spark.createDataFrame([(b,) for b in BODIES], "body string")
    for r in L.parse_labels(df).select("body", "label_ok").collect():
        want = _python_object(r.body)
        assert r.label_ok == want, r.body
    for r in df.select("body", L.label_valid(F.col("body")).alias("ok")).collect():
        assert r.ok == _python_object(r.body), r.body
    for r in P.parse_portfolio(df).select("body", "portfolio_ok").collect():
        want = _python_object(r.body) and all(isinstance(v, dict) for v in json.loads(r.body).values())
        assert r.portfolio_ok == want, r.body


def test_user_flag_is_boolean_or_null(spark):
    values = ["true", "false", '"yes"', "1", "2.5", '"no"', "0", "null"]
    rows = [(i, '{"ethereum":{"isUserAddress":%s}}' % v) for i, v in enumerate(values)]
    parsed = L.parse_labels(spark.createDataFrame(rows, "i int, body string"))
    got = [r.u for r in parsed.orderBy("i").select(F.col("label_chains")[0]["is_user"].alias("u")).collect()]
    assert got[:7] == [True, False, None, None, None, None, None] and not got[7]


DAYS = T.StructType([T.StructField("a", T.LongType()), T.StructField("day", T.DateType())])


def _partitioned(spark, tmp_dir, name):
    ns = f"r2_{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{tmp_dir}/{ns}'")
    assert tables.create_table(spark, ns, "t", "d", DAYS, root=f"{tmp_dir}/{ns}-data", partition_by=["day"])
    return ns


def _csv(spark, tmp_dir, name, rows):
    path = os.path.join(tmp_dir, name)
    write_csv(spark.createDataFrame(rows, "a long, day date"), path)
    return path


def test_partitioned_clear_and_refresh(spark, tmp_dir):
    ns = _partitioned(spark, tmp_dir, os.path.basename(tmp_dir).replace("-", "_"))
    one = _csv(spark, tmp_dir, "one", [(1, dt.date(2024, 1, 14)), (2, dt.date(2024, 1, 15))])
    two = _csv(spark, tmp_dir, "two", [(3, dt.date(2024, 1, 15))])
    assert tables.load_csv(spark, one, ns, "t").rows_written == 2
    assert tables.load_csv(spark, two, ns, "t", mode="refresh").rows_written == 1
    assert [r.a for r in spark.table(f"{ns}.t").collect()] == [3]
    assert tables.load_csv(spark, one, ns, "t", mode="refresh").rows_written == 2
    assert tables.clear_table(spark, ns, "t") and spark.table(f"{ns}.t").count() == 0


def test_rejects_are_counted_and_not_ok(spark, tmp_dir):
    ns = f"r2r_{os.path.basename(tmp_dir).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{tmp_dir}/{ns}'")
    tables.create_table(spark, ns, "t", "d", T.StructType([T.StructField("a", T.LongType())]), root=f"{tmp_dir}/{ns}-data")
    path = os.path.join(tmp_dir, "c")
    write_csv(spark.createDataFrame([("1",), ("x",)], "a string"), path)
    lost = tables.load_csv(spark, path, ns, "t")
    assert (lost.ok, lost.rows_written, lost.rejected) == (False, 1, 1)
    kept = tables.load_csv(spark, path, ns, "t", reject_path=os.path.join(tmp_dir, "rejects"))
    assert (kept.ok, kept.rejected) == (True, 1) and spark.read.parquet(os.path.join(tmp_dir, "rejects")).count() == 1
    assert tables.load_csv(spark, path, ns, "t", max_lost=1).ok


def test_csv_header_is_checked(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h")
    write_csv(spark.createDataFrame([("1", "2")], "usd string, balance string"), path)
    with pytest.raises(Exception):
        read_csv(spark, path, ["balance", "usd"]).collect()


def _namespace(spark, tmp_dir):
    ns = f"r2j_{os.path.basename(tmp_dir).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{tmp_dir}/{ns}'")
    return dict(namespace=ns, name="t", table_root=f"{tmp_dir}/{ns}-data", csv_dir=os.path.join(tmp_dir, "csv"), filename="f.csv")


def test_label_job_rerun_appends_once(spark, tmp_dir):
    where = _namespace(spark, tmp_dir)
    service = LoggingService(os.path.join(tmp_dir, "l"))
    for _ in range(2):
        jobs.label_job(spark, _keys(spark, 2), service, opts=FetchOptions(kind="labels", **FAST), landing=os.path.join(tmp_dir, "landing"), **where)
    assert spark.table(f"{where['namespace']}.t").count() == 2


def test_portfolio_job_refreshes_to_empty_wallets(spark, tmp_dir):
    where = _namespace(spark, tmp_dir)
    body = json.dumps({"ethereum": {"t": {"symbol": "A", "balance": 1, "price": 2, "usd": 3}}})

    def job(answer):
        class Service:
            def __call__(self, req):
                return answer

        jobs.portfolio_job(spark, _keys(spark, 2), Service(), opts=FetchOptions(kind="portfolio", max_rounds=1, **FAST), **where)
        return spark.table(f"{where['namespace']}.t").count()

    full = job((200, body))
    assert job((500, None)) == full
    assert job((200, "{}")) == 0


def test_latest_result_of_no_rows(spark):
    assert latest_result(spark.createDataFrame([], "run_ts long, x int")).count() == 0


def test_loaded_rows_equal_the_rows_of_their_csv(spark, tmp_dir):
    where = f"r2l_{os.path.basename(tmp_dir).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {where} LOCATION '{tmp_dir}/{where}'")
    schema = T.StructType([T.StructField("address", T.BinaryType()), T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType()), T.StructField("day", T.DateType())])
    for t in ("by_csv", "by_rows"):
        assert tables.create_table(spark, where, t, "d", schema, root=f"{tmp_dir}/{where}-{t}")
    day = dt.date(2024, 1, 15)
    rows = spark.createDataFrame(
        [("0xab", 'a,"b"', True, day), ("0xAB", "", False, None), ("nothex", "x", True, day), (None, None, None, None), ("0x00", " s\nt ", None, day)],
        "address string, s string, b boolean, day date",
    )
    path = os.path.join(tmp_dir, "rows")
    write_csv(rows, path)
    one = tables.load_csv(spark, path, where, "by_csv", reject_path=os.path.join(tmp_dir, "r1"))
    two = tables.load_rows(spark, rows, where, "by_rows", reject_path=os.path.join(tmp_dir, "r2"))
    assert (one.rows_written, one.rejected) == (two.rows_written, two.rejected) and two.rejected >= 1
    read = lambda t: sorted(map(str, spark.table(f"{where}.{t}").collect()))
    assert read("by_csv") == read("by_rows")
    reasons = [sorted(map(str, spark.read.parquet(os.path.join(tmp_dir, r)).collect())) for r in ("r1", "r2")]
    assert reasons[0] == reasons[1]


def test_one_bad_page_fails_its_address(spark):
    good = json.dumps({"ethereum": {"t": dict(TOKEN, id="t", name="T")}})
    pages = spark.createDataFrame([("a", 1, good), ("a", 2, '{"ethereum":{"u":{}}}'), ("b", 1, good), ("b", 2, good), (None, 1, "[]"), (None, 2, good)], "address string, page int, body string")
    got = [r.address for r in P.paged_portfolio_rows(pages).collect()]
    assert got == ["b", "b"]


def test_throttle_pauses_every_call():
    import time

    import pandas as pd

    from walletflow.operators.fetch import _fetch_partitions

    class Limited:
        def __call__(self, req):
            return 429, None

    opts = FetchOptions(kind="labels", threads=2, request_delay=0.03, backoff_429=0.04)
    keys = pd.DataFrame({"address": [str(i) for i in range(10)], "context": [None] * 10})
    begin = time.monotonic()
    rows = pd.concat(_fetch_partitions(Limited(), 1, opts)([keys]))
    assert len(rows) == 10 and set(rows["status"]) == {"429"}
    assert time.monotonic() - begin >= 5 * (0.03 + 0.04)


@pytest.mark.parametrize("key", ["a", "a.b", "it's", 'q"q', "x y", "*", "a?"])
def test_any_key_is_extracted(spark, key):
    docs = [{key: "v", "z": 1}, {key: None}, {"z": 2}, {key: 3}, {"a": {"b": "other"}} if key != "a" else {}]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, js string")
    got = {r[0]: r[2] for r in column_values(rows, key, "js").collect()}
    assert got == {0: "v", 1: None, 3: "3"}
    assert tuple(extract_stats(rows, key, "js").first()) == (5, 3, 2)


def test_job_reads_its_keys_once(spark, tmp_dir):
    import random

    fresh = F.udf(lambda i: "0x%040x" % random.getrandbits(60), "string").asNondeterministic()
    keys = spark.range(20).select(fresh("id").alias("address"))
    where = _namespace(spark, tmp_dir)
    service = LoggingService(os.path.join(tmp_dir, "l"))
    done = jobs.label_job(spark, keys, service, opts=FetchOptions(kind="labels", **FAST), **where)
    assert done.fetch.n_success == done.rows_written == spark.table(f"{where['namespace']}.t").count() == 20
