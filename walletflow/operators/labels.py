"""Label documents -> flat label rows (one row per address).

A label document maps chain name -> chain object::

    {"<chain>": {"address": ..., USER_KEY: bool,
                 ENTITY_KEY: {name, type, website, twitter, crunchbase, linkedin},
                 LABEL_KEY: {"name": ...}}, ...}

(the key names are fixed values in ``walletflow.schemas``).

Everything is a Catalyst expression over one ``from_json(body,
'map<string,variant>')``: the top level is parsed as a *map* so document
order is kept (a top-level VARIANT would sort keys), each chain value as a
VARIANT so that non-object siblings, truthiness and missing-vs-null can be
told apart.  No shuffle: the operator is a narrow projection.

Rules kept from the reference behaviour:

* non-object chain entries are skipped; duplicate chain keys keep the last
  value at the first position;
* an entity / label exists only when its value is truthy; a truthy
  non-object value fails the whole document (it goes to the failure set);
* body that is not a JSON object (list, null, empty, broken) fails;
* ``{}`` succeeds with a row of blanks and ``isUserAddress = false``;
* entity fields come only from the primary chain (first present of the
  priority list, else the first chain in document order); the label comes
  from the primary chain when it has a label object (even with an empty
  name), else from the first chain in document order that has one;
* absent keys take their default ('' / false), JSON nulls stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletflow.functions.jsonmap import is_object, json_class, ordered_entries, parsed_once, text_or_default, parse_whole, with_marked_numbers
from walletflow.functions.once import evaluate_once
from walletflow.schemas import (
    ENTITY_FIELDS,
    ENTITY_KEY,
    LABEL_KEY,
    LABEL_RECORD_FIELDS,
    LOOSE_MAP_DDL,
    PRIORITY_CHAINS,
    USER_KEY,
)

def _chain_struct(e: Column, i: Column) -> Column:
    v = e["value"]
    return F.struct(
        e["key"].alias("chain"),
        i.alias("pos"),
        F.variant_get(v, f"$.{ENTITY_KEY}", "variant").alias("ent"),
        F.variant_get(v, f"$.{LABEL_KEY}", "variant").alias("lab"),
        F.try_variant_get(v, f"$.{USER_KEY}", "variant").alias("iu"),
    )


def _typed_chain(c: Column) -> Column:
    ent, lab, iu = c["ent"], c["lab"], c["iu"]
    return F.struct(
        c["chain"].alias("chain"),
        c["pos"].alias("pos"),
        json_class(ent).alias("ent_cls"),
        json_class(lab).alias("lab_cls"),
        ent.alias("ent"),  # entity fields are read from the primary chain only
        text_or_default(lab, "name").alias("label_name"),
        F.when(iu.isNull(), F.lit(False))
        .when(F.schema_of_variant(iu) == "BOOLEAN", F.try_variant_get(iu, "$", "boolean"))  # others: NULL (D11)
        .alias("is_user"),
    )


def parse_labels(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``label_ok`` (document accepted) and ``label_chains`` (typed,
    ordered chain objects) to ``df``.  The document is parsed once per row."""
    staged = parsed_once(df, "_lab_m", with_marked_numbers(F.col(body)), LOOSE_MAP_DDL)
    m = F.col("_lab_m")
    raw = F.transform(F.filter(ordered_entries(m), lambda e: is_object(e["value"])), _chain_struct)
    chains = F.transform(raw, _typed_chain)
    parsed = F.struct(m.isNotNull().alias("parsed"), chains.alias("chains"))
    staged = evaluate_once(staged, "_lab", parsed)
    bad = F.exists(F.col("_lab.chains"), lambda c: (c["ent_cls"] == "bad") | (c["lab_cls"] == "bad"))
    return staged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.coalesce(F.col("_lab.parsed") & ~bad, F.lit(False)).alias("label_ok"),
        F.col("_lab.chains").alias("label_chains"),
    )


def label_valid(body: Column) -> Column:
    """Only the accept / fail decision of ``parse_labels`` (used per fetch
    round): parsed as an object and no truthy non-object entity or label."""
    return label_map_valid(parse_whole(body, LOOSE_MAP_DDL))


def label_map_valid(m: Column) -> Column:
    """``label_valid`` of a parsed document."""
    objs = F.filter(ordered_entries(m), lambda e: is_object(e["value"]))

    def bad(e: Column) -> Column:
        v = e["value"]
        return (json_class(F.variant_get(v, f"$.{ENTITY_KEY}", "variant")) == "bad") | (
            json_class(F.variant_get(v, f"$.{LABEL_KEY}", "variant")) == "bad"
        )

    return F.coalesce(m.isNotNull() & ~F.exists(objs, bad), F.lit(False))


def primary_chain(chains: Column) -> Column:
    """First present chain of the priority list, else the first chain."""
    def named(name: str):
        return lambda c: c["chain"] == name

    picks = [F.get(F.filter(chains, named(p)), 0) for p in PRIORITY_CHAINS]
    return F.coalesce(*picks, F.get(chains, 0))


def fallback_label(chains: Column, primary: Column) -> tuple[Column, Column]:
    """(label text, chain it came from)."""
    first_labelled = F.get(F.filter(chains, lambda c: c["lab_cls"] == "object"), 0)
    has_primary_label = F.coalesce(primary["lab_cls"] == "object", F.lit(False))
    label = (
        F.when(has_primary_label, primary["label_name"])
        .when(first_labelled.isNotNull(), first_labelled["label_name"])
        .otherwise(F.lit(""))
    )
    source = F.when(has_primary_label, primary["chain"]).otherwise(first_labelled["chain"])
    return label, source


def with_primary(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("label_primary", primary_chain(F.col("label_chains")))


def flat_label_columns(primary: Column, chains: Column) -> list[Column]:
    has_entity = F.coalesce(primary["ent_cls"] == "object", F.lit(False))
    cols = [F.when(has_entity, text_or_default(primary["ent"], f)).otherwise(F.lit("")).alias(f)
            for f in ENTITY_FIELDS]
    label, _ = fallback_label(chains, primary)
    cols.append(label.alias("label"))
    cols.append(F.when(primary.isNull(), F.lit(False)).otherwise(primary["is_user"]).alias("isUserAddress"))
    return cols


def flatten_labels(parsed: DataFrame, address: str = "address", keep: list[str] | None = None) -> DataFrame:
    """Flat 9-field label rows of the accepted documents.

    ``address`` is the requested key, not the one inside the document.
    """
    keep = keep or []
    p = with_primary(parsed.filter(F.col("label_ok")))
    return p.select(
        *[F.col(k) for k in keep],
        F.col(address).alias("address"),
        *flat_label_columns(F.col("label_primary"), F.col("label_chains")),
    )


def label_rows(df: DataFrame, body: str = "body", address: str = "address", keep: list[str] | None = None) -> DataFrame:
    """Documents -> flat rows (accepted documents only)."""
    return flatten_labels(parse_labels(df, body), address, keep)


def label_failures(df: DataFrame, body: str = "body") -> DataFrame:
    """Documents that the label rules reject."""
    return parse_labels(df, body).filter(~F.col("label_ok")).drop("label_ok", "label_chains")


def label_record(flat: DataFrame) -> DataFrame:
    """The flat record as one JSON object per address (to_dict form)."""
    return flat.select(
        "address",
        F.to_json(F.struct(*[F.col(c) for c in LABEL_RECORD_FIELDS])).alias("record"),
    )


def label_chain_rows(parsed: DataFrame, address: str = "address") -> DataFrame:
    """One row per kept chain object of accepted documents (document order)."""
    return parsed.filter(F.col("label_ok")).select(
        F.col(address).alias("address"), F.explode("label_chains").alias("c")
    ).select(
        "address",
        F.col("c.chain").alias("chain"),
        (F.col("c.pos") + 1).alias("pos"),
        F.col("c.is_user").alias("is_user_address"),
        (F.col("c.ent_cls") == "object").alias("has_entity"),
        (F.col("c.lab_cls") == "object").alias("has_label"),
    )
