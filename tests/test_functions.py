"""Column helpers against their plain-Python meaning."""

import json
import random

from pyspark.sql import functions as F

from walletflow.functions.address import address_from_key, address_problem
from walletflow.functions.jsonmap import ordered_entries


def test_ordered_entries_is_python_dict_semantics(spark):
    rng = random.Random(3)
    docs = []
    for _ in range(200):
        pairs = [(rng.choice("abcdefgh"), rng.randint(0, 99)) for _ in range(rng.randint(0, 30))]
        docs.append("{" + ",".join(f'"{k}":{v}' for k, v in pairs) + "}")
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, body string")
    got = df.select("i", ordered_entries(F.from_json("body", "map<string,int>")).alias("e")).collect()
    for r in got:
        expected = list(json.loads(docs[r["i"]]).items())
        assert [(e["key"], e["value"]) for e in r["e"]] == expected, docs[r["i"]]


def test_address_helpers(spark):
    df = spark.createDataFrame([(0,), (255,), (2**40,)], "k long").select(address_from_key(F.col("k")).alias("a"))
    assert [r["a"] for r in df.collect()] == ["0x" + f"{k:040x}" for k in (0, 255, 2**40)]
    cases = ["0x" + "ab" * 20, "ab" * 20, "0xabc", "0x" + "zz" * 20, None, "0x"]
    got = [r["p"] for r in spark.createDataFrame([(c,) for c in cases], "a string")
           .select(address_problem(F.col("a")).alias("p")).collect()]
    assert got == [None, "missing 0x prefix", "odd number of hex digits", "non-hex character", "null address", None]
