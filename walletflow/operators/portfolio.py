"""Portfolio documents -> validity and flat token rows.

A portfolio document maps network -> token id -> token, each token holding
six keys (id, name, symbol, balance, price, usd), all required:

* validity is per document and is decided over **all** networks, also
  those that are not exported: one token lacking one key, a network that
  is not an object, or a token that is not an object fails the address; a
  key present with a JSON null is fine;
* exported networks are kept in list order, ``arbitrum_one`` is shown as
  ``arbitrum``; tokens keep document order; an empty network gives no row.

Validation runs in two tiers.  A typed ``from_json`` to
``map<string,map<string,struct<6 strings>>>`` is the fast gate: no
duplicate keys and no NULL anywhere means valid.  Only documents that fail
the gate take the strict VARIANT path, which can tell a missing key from a
JSON null.  Both are built-in expressions; the operator is a narrow
projection plus two ``posexplode`` generators, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletflow.functions.jsonmap import as_written, is_object, key_present, ordered_entries, parsed_once, with_marked_numbers
from walletflow.functions.once import evaluate_once
from walletflow.schemas import CHAIN_RENAME, EXPORT_CHAINS, LOOSE_MAP_DDL, PORTFOLIO_DDL, TOKEN_FIELDS


def _no_dup_keys(m: Column) -> Column:
    return F.size(F.array_distinct(F.map_keys(m))) == F.size(m)


def _fast_gate(p: Column) -> Column:
    def token_full(t: Column) -> Column:
        cond = t.isNotNull()
        for f in TOKEN_FIELDS:
            cond = cond & t[f].isNotNull()
        return cond

    def network_ok(n: Column) -> Column:
        return n.isNotNull() & _no_dup_keys(n) & F.forall(F.map_values(n), token_full)

    return p.isNotNull() & _no_dup_keys(p) & F.forall(F.map_values(p), network_ok)


def _strict_check(v: Column) -> Column:
    def token_ok(t: Column) -> Column:
        cond = is_object(t)
        for f in TOKEN_FIELDS:
            cond = cond & key_present(t, f)
        return cond

    def network_ok(e: Column) -> Column:
        n = e["value"]
        tokens = F.map_values(F.try_variant_get(n, "$", "map<string,variant>"))
        return is_object(n) & F.forall(tokens, token_ok)

    return F.coalesce(v.isNotNull() & F.forall(ordered_entries(v), network_ok), F.lit(False))


def parse_portfolio(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``portfolio_ok`` and the typed map ``portfolio_doc`` to ``df``.

    The typed parse runs once per row; the strict parse gets the text only of
    rows that fail the gate, and the check is lazy in its CASE."""
    staged = parsed_once(df, "_pf", with_marked_numbers(F.col(body)), PORTFOLIO_DDL)
    fast = F.coalesce(_fast_gate(F.col("_pf")), F.lit(False))
    staged = evaluate_once(staged, "_pf_fast", fast)
    staged = parsed_once(staged, "_pf_loose", F.when(~F.col("_pf_fast"), F.col(body)), LOOSE_MAP_DDL)
    staged = evaluate_once(
        staged, "_pf_ok", F.when(F.col("_pf_fast"), F.lit(True)).otherwise(_strict_check(F.col("_pf_loose")))
    )
    return staged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_pf").alias("portfolio_doc"),
        F.col("_pf_ok").alias("portfolio_ok"),
    )


def paged_portfolio_rows(pages: DataFrame, body: str = "body", address: str = "address",
                         page: str = "page", with_rank: bool = False) -> DataFrame:
    """Flat token rows of paged documents, of the addresses whose pages are all valid.

    Every page is parsed and flattened once; its rows, and one marked row per invalid page, are
    written to the shared folder.  The invalid addresses are then read there and removed."""
    from walletflow.session import scratch_path

    spark = pages.sparkSession
    path = scratch_path(spark, "paged-rows")
    rows = flatten_portfolio(parse_portfolio(pages, body), address, keep=[page], with_rank=with_rank, mark_invalid=True)
    rows.write.parquet(path)
    landed = spark.read.schema(rows.schema).parquet(path)
    invalid = landed.where("portfolio_bad").select(F.col("address").alias("_invalid")).distinct()
    return landed.where(~F.col("portfolio_bad")).join(invalid, F.col("address").eqNullSafe(F.col("_invalid")), "left_anti").drop("portfolio_bad")


def portfolio_summary(parsed: DataFrame, address: str = "address") -> DataFrame:
    """Per document: valid flag, networks and tokens (after key collapse)."""
    nets = ordered_entries(F.col("portfolio_doc"))
    n_tokens = F.aggregate(nets, F.lit(0), lambda acc, e: acc + F.coalesce(F.size(F.array_distinct(F.map_keys(e["value"]))), F.lit(0)))
    return parsed.select(
        F.col(address).alias("address"),
        F.col("portfolio_ok").alias("is_valid"),
        F.when(F.col("portfolio_ok"), F.size(nets).cast("bigint")).alias("n_networks"),
        F.when(F.col("portfolio_ok"), n_tokens.cast("bigint")).alias("n_tokens"),
    )


def exported_networks(parsed: DataFrame, address: str = "address", keep: list[str] | None = None,
                      mark_invalid: bool = False) -> DataFrame:
    """(address, chain, chain_rank, tokens) for exported networks of valid documents; with
    ``mark_invalid`` also one row per invalid document, ``portfolio_bad`` true and the rest NULL."""
    keep = keep or []
    order = F.array(*[F.lit(c) for c in EXPORT_CHAINS])
    own, bad = [F.col(k) for k in keep], ~F.col("portfolio_ok")
    exported = F.col("net.key").isin(EXPORT_CHAINS)
    nets = ordered_entries(F.col("portfolio_doc"))
    if mark_invalid:
        own.append(bad.alias("portfolio_bad"))
        found = parsed.select(*own, F.col(address).alias("address"), F.explode_outer(F.when(~bad, nets)).alias("net")).filter(
            F.col("portfolio_bad") | F.coalesce(exported, F.lit(False))
        )
        own = [F.col(k) for k in keep] + [F.col("portfolio_bad")]
    else:
        found = parsed.filter(F.col("portfolio_ok")).select(*own, F.col(address).alias("address"), F.explode(nets).alias("net")).filter(exported)
    return found.select(
        *own,
        "address",
        F.col("net.key").alias("chain"),
        F.array_position(order, F.col("net.key")).cast("int").alias("chain_rank"),
        F.col("net.value").alias("tokens"),
    )


def display_chain(chain: Column) -> Column:
    out = chain
    for src, dst in CHAIN_RENAME.items():
        out = F.when(chain == src, F.lit(dst)).otherwise(out)
    return out


def flatten_portfolio(parsed: DataFrame, address: str = "address", keep: list[str] | None = None,
                      with_rank: bool = False, mark_invalid: bool = False) -> DataFrame:
    """Token rows: chain, address, symbol, balance, price, usd (``mark_invalid``: see
    ``exported_networks``)."""
    keep = keep or []
    nets = exported_networks(parsed, address, keep, mark_invalid)
    if mark_invalid:
        keep = [*keep, "portfolio_bad"]
    one = F.posexplode_outer if mark_invalid else F.posexplode
    tok = nets.select(
        *[F.col(k) for k in keep], "address", "chain", "chain_rank",
        one(ordered_entries(F.col("tokens"))).alias("tpos", "t"),
    )
    if mark_invalid:
        tok = tok.filter(F.col("portfolio_bad") | F.col("t").isNotNull())
    cols = [
        *[F.col(k) for k in keep],
        display_chain(F.col("chain")).alias("chain"),
        F.col("address"),
        as_written(F.col("t.value.symbol")).alias("symbol"),
        as_written(F.col("t.value.balance")).alias("balance"),
        as_written(F.col("t.value.price")).alias("price"),
        as_written(F.col("t.value.usd")).alias("usd"),
    ]
    if with_rank:
        cols += [F.col("chain_rank"), (F.col("tpos") + 1).alias("token_rank")]
    return tok.select(*cols)


def portfolio_rows(df: DataFrame, body: str = "body", address: str = "address",
                   keep: list[str] | None = None, with_rank: bool = False) -> DataFrame:
    return flatten_portfolio(parse_portfolio(df, body), address, keep, with_rank)


def decimal_view(rows: DataFrame) -> DataFrame:
    """Token rows with balance, price and usd as decimal(38,18) beside their text, in columns that end
    in ``_decimal``; NULL where the text is no number or does not fit."""
    numbers = {f"{c}_decimal": F.col(c).try_cast("decimal(38,18)") for c in ("balance", "price", "usd")}
    return rows.withColumns(numbers)


def portfolio_failures(df: DataFrame, body: str = "body") -> DataFrame:
    return parse_portfolio(df, body).filter(~F.col("portfolio_ok")).drop("portfolio_ok", "portfolio_doc")
