"""JSON map helpers with the semantics of a Python ``dict`` built by ``json``.

* ``ordered_entries``: ``from_json`` to a map keeps every duplicate key in
  document order.  A Python dict keeps one entry per key, at the position of
  the first occurrence, holding the last value.
* ``json_class``: Python truthiness of a parsed JSON value, as one of
  ``none`` (absent, null, {}, [], "", 0, false), ``object`` (non-empty
  object) and ``bad`` (any other truthy value, which would make ``.get``
  raise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletflow.functions.once import evaluate_once

# Numbers keep their text: before a document is parsed, every number token outside strings
# becomes a string that starts with this private-use character.
NUMBER_MARK = "\ue0f1"
# From the end of the last match: whole strings and other characters, then a JSON number (what is none
# stays and fails the parse).  Every repeat is possessive, so the pass is linear and needs no stack.
_NUMBER = (
    r'\G((?:[^"\-0-9]++|"(?:[^"\\]++|\\.)*+")*+)'
    r"(-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+)(?=[ \t\r\n]*+(?:[,\]}]|$))"
)
_MAYBE_NUMBER = r"[:,\[][ \t\r\n]*+-?[0-9]"
_NUMBER_FIRST = r"\A[ \t\r\n]*+-?[0-9]"


def with_marked_numbers(body: Column) -> Column:
    """The document with its number tokens as marked strings.  Documents without numbers, and those
    that hold the mark already, stay as they are."""
    marked = F.regexp_replace(body, _NUMBER, f'$1"{NUMBER_MARK}$2"')
    maybe = body.rlike(_MAYBE_NUMBER) | body.rlike(_NUMBER_FIRST)
    return F.when(maybe & ~F.contains(body, F.lit(NUMBER_MARK)), marked).otherwise(body)


def as_written(text: Column) -> Column:
    """Text of a value from a marked document: a number as it was written, also inside JSON text."""
    inner = F.regexp_replace(text, f'"{NUMBER_MARK}([^"]*+)"', "$1")
    return F.when(F.startswith(text, F.lit(NUMBER_MARK)), F.substring(text, 2, 1 << 30)).when(F.contains(text, F.lit(NUMBER_MARK)), inner).otherwise(text)


def parse_whole(body: Column, kind: str) -> Column:
    """``body`` parsed as one JSON object of the map type ``kind``; NULL unless the whole
    text is that object.  The JSON reader stops at the end of a value, so the text is read as
    the first of two members: anything after the object, or an early close, leaves other keys."""
    return _first_of_two(_both(_wrapped(body), kind))


def _wrapped(body: Column) -> Column:
    return F.concat(F.lit('{"d":'), body, F.lit(',"e":{}}'))


def _both(wrapped: Column, kind: str) -> Column:
    return F.from_json(wrapped, f"map<string,{kind}>", {"allowSingleQuotes": "false"})


def _first_of_two(both: Column) -> Column:
    whole = F.map_keys(both) == F.array(F.lit("d"), F.lit("e"))
    return F.when(whole, F.get(F.map_values(both), F.lit(0)))


def parsed_once(df: DataFrame, name: str, body: Column, kind: str) -> DataFrame:
    """``df`` with ``parse_whole(body, kind)`` as ``name``.  Both members are asked for twice, the text is
    a search and a replacement: each is made once per row, behind a generator of its own."""
    text, both = f"{name}_text", f"{name}_both"
    staged = evaluate_once(df, text, _wrapped(body))
    staged = evaluate_once(staged, both, _both(F.col(text), kind)).drop(text)
    return evaluate_once(staged, name, _first_of_two(F.col(both))).drop(both)


def ordered_entries(m: Column) -> Column:
    """array<struct<key,value>> of a map, duplicates collapsed dict-style.

    Maps without duplicate keys (the common case) take the cheap branch.
    Otherwise, in O(n log n): entries are tagged with their position and
    sorted by (key, position); the first element of each key run gives the
    position, the last one the value; the survivors are put back in
    position order.
    """
    keys = F.array_distinct(F.map_keys(m))
    tagged = F.transform(
        F.map_entries(m), lambda e, i: F.struct(e["key"].alias("key"), i.alias("pos"), e["value"].alias("value"))
    )

    def by_key_pos(a: Column, b: Column) -> Column:
        return (
            F.when(a["key"] < b["key"], F.lit(-1))
            .when(a["key"] > b["key"], F.lit(1))
            .when(a["pos"] < b["pos"], F.lit(-1))
            .when(a["pos"] > b["pos"], F.lit(1))
            .otherwise(F.lit(0))
        )

    def by_pos(a: Column, b: Column) -> Column:
        return F.when(a["pos"] < b["pos"], F.lit(-1)).when(a["pos"] > b["pos"], F.lit(1)).otherwise(F.lit(0))

    srt = F.array_sort(tagged, by_key_pos)
    n = F.size(srt)
    firsts = F.filter(srt, lambda e, i: (i == 0) | (F.get(srt, i - 1)["key"] != e["key"]))
    lasts = F.filter(srt, lambda e, i: (i == n - 1) | (F.get(srt, i + 1)["key"] != e["key"]))
    merged = F.zip_with(
        firsts, lasts, lambda f, l: F.struct(f["key"].alias("key"), f["pos"].alias("pos"), l["value"].alias("value"))
    )
    collapsed = F.transform(
        F.array_sort(merged, by_pos), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
    )
    return F.when(F.size(keys) == F.size(m), F.map_entries(m)).otherwise(collapsed)


def is_object(v: Column) -> Column:
    """True when a variant value is a JSON object (including ``{}``).

    Casting to a one-field struct succeeds only for objects and does not
    walk nested values, unlike ``schema_of_variant``."""
    return F.try_variant_get(v, "$", "struct<__wf_probe:int>").isNotNull()


def key_present(v: Column, key: str) -> Column:
    """Key present in a variant object (a JSON null counts as present).

    ``try_variant_get`` to ``variant`` returns SQL NULL only for an absent
    path; a JSON null comes back as a variant null.
    """
    return F.try_variant_get(v, f"$.{key}", "variant").isNotNull()


def json_class(v: Column) -> Column:
    """'none' | 'object' | 'bad' for a variant that may be SQL NULL.

    Objects are recognised by ``is_object``; the schema string is only
    computed for the remaining (scalar or array) values."""
    s = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    zero = F.startswith(text, F.lit(NUMBER_MARK)) & (F.substring(text, 2, 1 << 30).try_cast("double") == 0)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit("none"))
        .when(
            is_object(v),
            F.when(F.size(F.try_variant_get(v, "$", "map<string,variant>")) == 0, F.lit("none")).otherwise(
                F.lit("object")
            ),
        )
        .when(
            s.startswith("ARRAY"),
            F.when(F.size(F.try_variant_get(v, "$", "array<variant>")) == 0, F.lit("none")).otherwise(
                F.lit("bad")
            ),
        )
        .when(s == "STRING", F.when(text == "", F.lit("none")).when(zero, F.lit("none")).otherwise(F.lit("bad")))
        .when(s == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), F.lit("bad")).otherwise(F.lit("none")))
        .when(F.try_variant_get(v, "$", "double") == 0, F.lit("none"))
        .otherwise(F.lit("bad"))
    )


def text_or_default(v: Column, key: str, default: str = "") -> Column:
    """``data.get(key, default)`` rendered as the CSV text the reference
    writes: absent -> default, JSON null -> NULL, booleans -> 'True'/'False',
    numbers of a marked document -> as written, other scalars -> their text, objects and arrays ->
    JSON text."""
    x = F.try_variant_get(v, f"$.{key}", "variant")
    s = F.schema_of_variant(x)
    return (
        F.when(x.isNull(), F.lit(default))
        .when(F.is_variant_null(x), F.lit(None).cast("string"))
        .when(s == "BOOLEAN", F.when(F.try_variant_get(x, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
        .when(s.startswith("OBJECT") | s.startswith("ARRAY"), as_written(F.to_json(x)))
        .otherwise(as_written(F.try_variant_get(x, "$", "string")))
    )
