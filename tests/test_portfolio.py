"""Portfolio validity and flatten on the edge corpus."""

from tests.pyrules import py_portfolio
from walletflow.operators import portfolio as P

VALIDITY = [
    ('{"eth":{"t1":{"id":"1","name":"n","symbol":"s","balance":"1","price":null,"usd":"2"}}}', True, 1),
    ('{"eth":{"t1":{"id":"1"}}}', False, None),
    ('{"eth":{}}', True, 0),
    ("{}", True, 0),
    ('{"eth":null}', False, None),
    ('{"eth":{"t":5}}', False, None),
    ('{"eth":[1]}', False, None),
    ("[]", False, None),
    ('{"x":{"t1":{"id":1,"name":"n","symbol":"s","balance":1.5,"price":1e-7,"usd":2}},"eth":{"t":null}}', False, None),
]


def _df(spark, bodies):
    return spark.createDataFrame([(f"0x{i:040x}", b) for i, b in enumerate(bodies)], "address string, body string")


def test_validity_corpus(spark):
    s = P.portfolio_summary(P.parse_portfolio(_df(spark, [b for b, _, _ in VALIDITY])))
    got = {r["address"]: (r["is_valid"], r["n_tokens"]) for r in s.collect()}
    for i, (body, valid, n) in enumerate(VALIDITY):
        assert got[f"0x{i:040x}"] == (valid, n), body


FLATTEN = [
    '{"ethereum":{"t1":{"id":"1","name":"n","symbol":"s","balance":"1","price":null,"usd":"2"}}}',
    '{"polygon":{"p":{"id":"1","name":"n","symbol":"p","balance":"1","price":"1","usd":"1"}},'
    '"ethereum":{"b":{"id":"b","name":"n","symbol":"B","balance":"2","price":"3","usd":"6"},'
    '"a":{"id":"a","name":"n","symbol":"A","balance":"1","price":"1","usd":"1"}},'
    '"arbitrum_one":{"z":{"id":"z","name":"n","symbol":"Z","balance":"9","price":"9","usd":"81"}},'
    '"base":{}}',
    # duplicate network and token keys: last value at the first position
    '{"ethereum":{"a":{"id":"a","name":"n","symbol":"A1","balance":"1","price":"1","usd":"1"},'
    '"b":{"id":"b","name":"n","symbol":"B","balance":"1","price":"1","usd":"1"},'
    '"a":{"id":"a","name":"n","symbol":"A2","balance":"1","price":"1","usd":"1"}},'
    '"optimism":{"o":{"id":"o","name":"n","symbol":"O1","balance":"1","price":"1","usd":"1"}},'
    '"optimism":{"o":{"id":"o","name":"n","symbol":"O2","balance":"1","price":"1","usd":"1"}}}',
    # invalid because a non-exported network lacks a key
    '{"ethereum":{"a":{"id":"a","name":"n","symbol":"A","balance":"1","price":"1","usd":"1"}},'
    '"polygon":{"p":{"id":"p"}}}',
]


def test_flatten_matches_python_rules_in_order(spark):
    rows = P.portfolio_rows(_df(spark, FLATTEN), with_rank=True).collect()
    for i, body in enumerate(FLATTEN):
        addr = f"0x{i:040x}"
        mine = sorted((r for r in rows if r["address"] == addr), key=lambda r: (r["chain_rank"], r["token_rank"]))
        got = [tuple(r)[:6] for r in mine]
        expected = py_portfolio(addr, body) or []
        assert got == expected, body



def test_paged_documents_fail_as_a_whole(spark):
    tok = '{{"id":"{i}","name":"n","symbol":"{s}","balance":"1","price":"1","usd":"1"}}'
    pages = spark.createDataFrame(
        [
            ("A", 0, '{"ethereum":{"a":' + tok.format(i="a", s="A1") + "}}"),
            ("A", 1, '{"ethereum":{"b":{"id":"b"}}}'),  # a key is missing on page 1
            ("B", 0, '{"ethereum":{"a":' + tok.format(i="a", s="B1") + "}}"),
            ("B", 1, '{"base":{"c":' + tok.format(i="c", s="B2") + "}}"),
        ],
        "address string, page int, body string",
    )
    rows = sorted((r["address"], r["chain"], r["symbol"]) for r in P.paged_portfolio_rows(pages).collect())
    assert rows == [("B", "base", "B2"), ("B", "ethereum", "B1")]


def test_registered_paged_landing_spans_pages(spark):
    from walletflow.plans import fixtures as fx
    from tests.conftest import SF_SMALL
    from pyspark.sql import functions as F

    pages = fx.landed(spark, SF_SMALL, "portfolio_pages")
    per = pages.groupBy("address", "network").agg(F.count("*").alias("n"))
    assert per.filter("n > 1").count() > 0
