"""Label rules on the edge corpus and on generated documents."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.pyrules import py_label
from walletflow.operators import labels as L

# (body, expected) – expected is None for a failed document, else
# (name, type, website, twitter, crunchbase, linkedin, label, isUserAddress)
CORPUS = [
    ('{"zeta":{"arkhamLabel":{"name":"Z"}},"base":{"arkhamEntity":{"name":"N","type":"cex","website":null}},'
     '"alpha":{"arkhamLabel":{"name":"A"}}}', ("N", "cex", None, "", "", "", "Z", False)),
    ('{"zeta":{"arkhamLabel":{"name":"Z"},"isUserAddress":true},"x":"{str","n":5,"nul":null,"l":[1]}',
     ("", "", "", "", "", "", "Z", True)),
    ('{"a":{"arkhamLabel":{"name":"1"}},"b":{},"a":{"arkhamLabel":{"name":"2","name":"3"}}}',
     ("", "", "", "", "", "", "3", False)),
    ("{}", ("", "", "", "", "", "", "", False)),
    ("[1,2]", None),
    ("null", None),
    ("", None),
    ('{"a":{"arkhamLabel":{"name":"1"}', None),
    ('{"a":{"arkhamLabel":{},"arkhamEntity":{"name":null}}}', (None, "", "", "", "", "", "", False)),
    ('{"a":{"arkhamLabel":"str"},"b":{"arkhamLabel":{"name":"B"}}}', None),
    ('{"bsc":{"isUserAddress":null,"arkhamLabel":{"name":""}},"q":{"arkhamLabel":{"name":"Q"}}}',
     ("", "", "", "", "", "", "", None)),
    ('{"optimism":{},"polygon":{"arkhamEntity":{"twitter":"t","crunchbase":"c","linkedin":"l"}},'
     '"q":{"arkhamLabel":{"x":1}}}', ("", "", "", "t", "c", "l", "", False)),
    ('{"a":{"arkhamEntity":0,"arkhamLabel":false},"b":{"arkhamLabel":{"name":7}}}',
     ("", "", "", "", "", "", "7", False)),
    ('{"a":{"arkhamLabel":{"name":"x"}},"b":5,"ethereum":"no","c":{"arkhamEntity":[1]}}', None),
    ('{"z":1,"ethereum":null}', ("", "", "", "", "", "", "", False)),
]


def _as_text(row):
    """Numbers become their text, as they do in the CSV."""
    return tuple(v if v is None or isinstance(v, (bool, str)) else str(v) for v in row)


def _run(spark, bodies):
    df = spark.createDataFrame([(f"0x{i:040x}", b) for i, b in enumerate(bodies)], "address string, body string")
    parsed = L.parse_labels(df)
    ok = {r["address"]: r["label_ok"] for r in parsed.select("address", "label_ok").collect()}
    flat = {r["address"]: tuple(r)[1:] for r in L.flatten_labels(parsed).collect()}
    return ok, flat


def test_edge_corpus(spark):
    ok, flat = _run(spark, [b for b, _ in CORPUS])
    for i, (body, expected) in enumerate(CORPUS):
        addr = f"0x{i:040x}"
        if expected is None:
            assert ok[addr] is False, body
            assert addr not in flat
        else:
            assert ok[addr] is True, body
            assert flat[addr] == expected, body


def test_corpus_agrees_with_python_rules(spark):
    _, flat = _run(spark, [b for b, _ in CORPUS])
    for i, (body, _) in enumerate(CORPUS):
        addr = f"0x{i:040x}"
        py = py_label(addr, body)
        assert (flat.get(addr) is None) == (py is None), body
        if py is not None:
            assert (addr, *flat[addr]) == _as_text(py), body


_scalar = st.one_of(st.none(), st.booleans(), st.integers(-2, 2), st.sampled_from(["", "s", "ethereum"]))
_small_obj = st.dictionaries(st.sampled_from(["name", "type", "twitter", "x"]), st.one_of(st.text(max_size=3), st.none()),
                             max_size=3)
_value = st.one_of(_scalar, _small_obj, st.lists(st.integers(), max_size=2))
_chain = st.fixed_dictionaries({}, optional={
    "arkhamEntity": _value,
    "arkhamLabel": _value,
    "isUserAddress": st.one_of(st.booleans(), st.none()),
    "address": st.text(max_size=2),
})
_doc = st.lists(
    st.tuples(st.sampled_from(["ethereum", "bsc", "base", "polygon", "solana", "zeta"]), st.one_of(_chain, _scalar)),
    max_size=5,
)


def _dump(pairs):
    # hand-built so duplicate keys survive into the text
    return "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}"


@settings(max_examples=3, deadline=None)
@given(st.lists(_doc, min_size=80, max_size=80))
def test_generated_documents_match_python_rules(spark, docs):
    bodies = [_dump(d) for d in docs]
    _, flat = _run(spark, bodies)
    for i, body in enumerate(bodies):
        addr = f"0x{i:040x}"
        py = py_label(addr, body)
        if py is None:
            assert addr not in flat, body
        else:
            assert (addr, *flat[addr]) == _as_text(py), body


def test_non_text_entity_fields_render_like_the_csv(spark):
    body = ('{"ethereum":{"arkhamEntity":{"name":true,"type":7,"website":1.5,"twitter":{"a":1},'
            '"crunchbase":[1,2],"linkedin":false},"arkhamLabel":{"name":false}}}')
    _, flat = _run(spark, [body])
    assert flat["0x" + "0" * 40] == ("True", "7", "1.5", '{"a":1}', "[1,2]", "False", "False", False)
