"""One as-of per request; number text as written."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from walletflow.functions.jsonmap import as_written, with_marked_numbers
from walletflow.operators import labels as L
from walletflow.operators import portfolio as P
from walletflow.sources.landed import as_of_requests


def test_requests_against_plain_search(spark):
    rnd = random.Random(6)
    start = dt.datetime(2024, 1, 1)
    moment = lambda: start + dt.timedelta(seconds=rnd.choice([rnd.randrange(200), rnd.randrange(90_000), rnd.randrange(9_000_000)]))
    versions = [(rnd.choice(["hot"] * 5 + ["a", "b"]), moment(), i, f"v{i}") for i in range(400)]
    versions += [("hot", start, 1000 + i, f"tie{i}") for i in range(3)] + [(None, start, 2000, "x"), ("a", None, 2001, "y")]
    asked = [(rnd.choice(["hot", "hot", "a", "b", "none"]), moment()) for _ in range(300)]
    asked += [("hot", start)] * 3 + [(None, start), ("a", None), ("hot", start - dt.timedelta(days=900))]
    requests = [(i, k, t) for i, (k, t) in enumerate(asked)]

    def best(key, at):
        fits = [(t, i, v) for k, t, i, v in versions if k is not None and k == key and t is not None and at is not None and t <= at]
        return max(fits)[1:] if fits else (None, None)

    history = spark.createDataFrame(versions, "key string, version_ts timestamp_ntz, version_id long, body string")
    frame = spark.createDataFrame(requests, "request_id long, key string, as_of timestamp_ntz")
    expected = {i: best(k, t) for i, k, t in requests}
    for bucket, fan in ((3600, 1024), (60, 2), (10**8, 4)):
        got = as_of_requests(history, frame, bucket_seconds=bucket, fan_out=fan).collect()
        assert len(got) == len(requests)
        assert {r.request_id: (r.version_id, r.body) for r in got} == expected


def test_no_window_spans_a_key_but_the_groups(spark):
    history = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1, "b")], "key string, version_ts timestamp_ntz, version_id long, body string")
    frame = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "request_id long, key string, as_of timestamp_ntz")
    plan = as_of_requests(history, frame)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and sum("_bucket" in w for w in windows) >= 2


def text(spark, body):
    return spark.createDataFrame([(body,)], "b string").select(as_written(with_marked_numbers(F.col("b")))).collect()[0][0]


@settings(max_examples=40, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8),
                    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=5), x, max_size=3), max_leaves=8))
def test_marked_documents_parse_to_the_same_text(spark, value):
    import json

    body = json.dumps({"d": value}, ensure_ascii=False)
    if "" not in body:
        assert text(spark, body) == body  # taking the marks out again gives the document back


def test_numbers_come_back_as_written(spark):
    long = "1234567890" * 4 + "1"
    doc = '{"ethereum":{"t":{"id":1,"name":2.0,"symbol":%s,"balance":%s,"price":%s,"usd":%s}}}'
    cells = ["1.0", long, "1e400", "-0.10"], ['"1.0"', '"x"', "null", "true"], ["{\"a\":[1.50,2]}", "1E-7", "0.0", "[]"]
    df = spark.createDataFrame([(str(i), doc % tuple(c)) for i, c in enumerate(cells)], "address string, body string")
    rows = P.portfolio_rows(df)
    got = {r.address: (r.symbol, r.balance, r.price, r.usd) for r in rows.collect()}
    assert got == {"0": ("1.0", long, "1e400", "-0.10"), "1": ("1.0", "x", None, "true"), "2": ('{"a":[1.50,2]}', "1E-7", "0.0", "[]")}
    typed = {r.address: (r.price_decimal, str(r.usd_decimal)) for r in P.decimal_view(rows).collect()}
    assert typed["0"] == (None, "-0.100000000000000000") and typed["2"][0] == 0

    label = '{"base":{"arkhamEntity":{"name":%s,"type":%s},"arkhamLabel":%s}}'
    cases = [(long, "1.0", '{"name":1e400}'), ("0.10", "false", "0.0"), ("-0", '{"x": 1.0}', "0e5"), ("1", "1", "7")]
    df = spark.createDataFrame([(str(i), label % c) for i, c in enumerate(cases)], "address string, body string")
    parsed = L.parse_labels(df)
    got = {r.address: (r.name, r.type, r.label) for r in L.flatten_labels(parsed.filter("label_ok")).collect()}
    assert got == {"0": (long, "1.0", "1e400"), "1": ("0.10", "False", ""), "2": ("-0", '{"x":1.0}', "")}  # 7 is no label object


def test_what_is_no_json_stays_invalid(spark):
    bodies = ["{1:{}}", '{1 :{}}', '{"a":01}', '{"a":1.}', '{"a":+1}', '{"a":1 2}', '{"a":--1}', '{"a":1e}', '{"a":1,}', '{"a":1} 2', '{"a":.5}', '{"a":1x}', "[1]", "1"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert [r.label_ok for r in L.parse_labels(df).collect()] == [False] * len(bodies)
    assert [r.portfolio_ok for r in P.parse_portfolio(df).collect()] == [False] * len(bodies)


def test_marking_is_linear(spark):
    import time

    body = "{" + ",".join(f'"k{i}":"v 1: {i} \\\\" "' for i in range(100_000)) + ',"z":1.50}'
    hostile = ['{"a":' + "-" * 1_000_000, '{"a": 1,' + '"' * 999_999, "1" * 1_000_000, ":1 " * 300_000]
    started = time.time()
    for b in [body, *hostile]:
        text(spark, b)
    assert time.time() - started < 30
