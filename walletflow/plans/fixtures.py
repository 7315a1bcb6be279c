"""Wallet-shaped data derived in Spark from the driver's tables.

The reference reads documents from a remote service; here they are built
from the TPC-H-like tables so that every query's work grows with the data
and the DuckDB oracle can compute the same answer relationally, without
JSON.  Address of customer ``k``: ``'0x' + lpad(lower(hex(k)), 40, '0')``.

* portfolio documents: lineitem ⋈ orders ⋈ part, per customer, network
  (from the order priority) and part; balance = sum of quantities, price =
  retail price, usd = sum of extended prices, each as decimal(18,2) text.
* label documents: per customer up to seven chains in a fixed document
  order, present / user / entity / label decided by modular rules.
* saved results: two runs of a key query over ``customer``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletflow.functions.address import address_from_key
from walletflow.schemas import ENTITY_KEY, LABEL_KEY, USER_KEY

# ---------------------------------------------------------------------------
# Fixed values of the derived fixtures.
# Network of an order, by order priority.
PRIORITY_NETWORK = {
    "1-URGENT": "ethereum",
    "2-HIGH": "arbitrum_one",
    "3-MEDIUM": "base",
    "4-NOT SPECIFIED": "optimism",
    "5-LOW": "polygon",
}
# Candidate chains of a label document, in document order.
LABEL_DOC_CHAINS = ["solana", "bsc", "base", "optimism", "polygon", "arbitrum_one", "ethereum"]
# Saved-result runs (older run first).
RESULT_RUNS = [("2024-01-14 00:00:00", 0.0), ("2024-01-15 00:00:00", 5000.0)]
# As-of time of the history lookup.
AS_OF = "2024-01-15 00:00:00"
# Page size of the paged portfolio landing used by the registered query (small on
# purpose, so that many addresses span several pages).
PAGE_TOKENS = 4
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out evenly: a compressed table may be one small file, that is one task, while what is
    built of its rows is long work.  As many parts as keep every core busy, or as shuffles have."""
    spark = rows.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts)


def portfolio_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, address, network, token_id, token struct) per customer/network/part.

    lineitem ⋈ orders is aggregated to (customer, network, part) before the
    part join, so the part side joins already-reduced rows.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    network = F.create_map(*[F.lit(x) for kv in PRIORITY_NETWORK.items() for x in kv])[F.col("o_orderpriority")]
    agg = (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .groupBy(F.col("o_custkey").alias("k"), network.alias("network"), F.col("l_partkey"))
        .agg(
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("qty"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("usd"),
        )
    )
    tok = agg.join(pt, agg.l_partkey == pt.p_partkey)
    return tok.select(
        "k",
        address_from_key(F.col("k")).alias("address"),
        "network",
        F.col("l_partkey").cast("string").alias("token_id"),
        F.struct(
            F.col("l_partkey").cast("string").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_name").alias("symbol"),
            F.col("qty").cast("string").alias("balance"),
            F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("price"),
            F.col("usd").cast("string").alias("usd"),
        ).alias("token"),
    )


def _holding_sums(spark: SparkSession, sf_dir: str, *together: str) -> DataFrame:
    """(k, code, l_partkey, qty, usd, parts): what ``portfolio_tokens`` sums, rows of equal ``together`` side by side.

    Narrow rows (keys, numbers, the part's name) pass three exchanges: by order, by part, by ``together``.
    The sums and whatever is gathered by those columns share the last one.  A
    part key that comes more than once would repeat rows before they are summed, so its names and prices
    travel as a list.  Orders and parts are the smaller sides: hashed, so that nothing is sorted.
    """
    money = "decimal(18,2)"
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast(money).alias("qty"), F.col("l_extendedprice").cast(money).alias("usd")
    )
    code = F.create_map(*[F.lit(x) for i, p in enumerate(PRIORITY_NETWORK) for x in (p, i)])[F.col("o_orderpriority")]
    od = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), code.cast("tinyint").alias("code"))
    pt = table(spark, sf_dir, "part").groupBy("p_partkey").agg(
        F.collect_list(F.struct(F.col("p_name").alias("name"), F.col("p_retailprice").cast(money).alias("price"))).alias("parts")
    )
    bought = li.join(od.hint("shuffle_hash"), li.l_orderkey == od.o_orderkey).select("k", "code", "l_partkey", "qty", "usd")
    named = bought.join(pt.hint("shuffle_hash"), bought.l_partkey == pt.p_partkey).drop("p_partkey")
    return named.repartition(*together).groupBy("k", "code", "l_partkey").agg(
        F.sum("qty").alias("qty"), F.sum("usd").alias("usd"), F.first("parts").alias("parts")
    )


def _token_texts(sums: DataFrame, *keep: str) -> DataFrame:
    """(k, network, token_id, tj) and ``keep``: a row with its JSON text per part of the sums."""
    names = list(PRIORITY_NETWORK.values())
    token_id = F.col("l_partkey").cast("string")
    return sums.select("*", F.explode("parts").alias("part")).select(
        "k",
        F.get(F.array(*[F.lit(n) for n in names]), F.col("code").cast("int")).alias("network"),
        token_id.alias("token_id"),
        F.to_json(F.struct(
            token_id.alias("id"),
            F.col("part.name").alias("name"),
            F.col("part.name").alias("symbol"),
            F.col("qty").cast("string").alias("balance"),
            F.col("part.price").cast("string").alias("price"),
            F.col("usd").cast("string").alias("usd"),
        )).alias("tj"),
        *keep,
    )


def portfolio_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``portfolio_tokens`` (k, network, token_id, tj), the rows of a customer side by side."""
    return _token_texts(_holding_sums(spark, sf_dir, "k"))


def portfolio_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, address, body) – one portfolio document per customer with orders.

    Tokens are collected once per customer and sorted natively by
    (network, token id); the JSON text is assembled from ``to_json`` of each
    token, so names are escaped by Spark.
    """
    docs = portfolio_holdings(spark, sf_dir).groupBy("k").agg(
        F.sort_array(F.collect_list(F.struct("network", "token_id", "tj"))).alias("toks")
    )
    toks = F.col("toks")
    networks = F.array_distinct(F.transform(toks, lambda t: t["network"]))

    def network_json(n: Column) -> Column:
        members = F.filter(toks, lambda t: t["network"] == n)
        inner = F.array_join(F.transform(members, lambda t: F.concat(F.lit('"'), t["token_id"], F.lit('":'), t["tj"])), ",")
        return F.concat(F.lit('"'), n, F.lit('":{'), inner, F.lit("}"))

    body = F.concat(F.lit("{"), F.array_join(F.transform(networks, network_json), ","), F.lit("}"))
    return docs.select("k", address_from_key(F.col("k")).alias("address"), body.alias("body"))


def portfolio_pages(spark: SparkSession, sf_dir: str, max_tokens: int = 1000) -> DataFrame:
    """(k, address, network, page, body) – the portfolio split into pages.

    Each page holds one network and at most about ``max_tokens`` tokens, so
    no group collected into one row grows with the data: the page count of
    a (customer, network) comes from a partial count, and tokens are spread
    over the pages by ``pmod(xxhash64(token_id), pages)`` (no window over a
    customer).  Tokens inside a page are in token-id order.
    """
    sums = _holding_sums(spark, sf_dir, "k", "code")
    # counted where the rows lie: the exchange is shared, and nothing is sorted for the join
    counts = sums.groupBy("k", "code").agg(F.sum(F.size("parts")).alias("n"))
    paged = _token_texts(sums.join(counts.hint("shuffle_hash"), ["k", "code"]), "n", "code").withColumn(
        "page", F.pmod(F.xxhash64("token_id"), F.ceil(F.col("n") / F.lit(max_tokens))).cast("int")
    ).withColumn("member", F.concat(F.lit('"'), F.col("token_id"), F.lit('":'), F.col("tj")))
    pages = paged.groupBy("k", "code", "network", "page").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("token_id", "member")))["member"], ",").alias("inner")
    )
    body = F.concat(F.lit('{"'), F.col("network"), F.lit('":{'), F.col("inner"), F.lit("}}"))
    return pages.select("k", address_from_key(F.col("k")).alias("address"), "network", "page", body.alias("body"))


def damaged_portfolio_documents(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Portfolio documents where ``k % 7 = 0`` lose every ``price`` key
    (invalid) and ``k % 7 = 3`` carry ``"price":null`` (still valid)."""
    docs = docs if docs is not None else portfolio_documents(spark, sf_dir)
    body = (
        F.when(F.col("k") % 7 == 0, F.regexp_replace("body", '"price":"[^"]*",', ""))
        .when(F.col("k") % 7 == 3, F.regexp_replace("body", '"price":"[^"]*"', '"price":null'))
        .otherwise(F.col("body"))
    )
    return docs.select("k", "address", body.alias("body"))


def label_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, address, body) – one label document per customer (maybe ``{}``)."""
    cust = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    # nation has a fixed 25 rows, so broadcasting it is bounded.
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    c = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    k = F.col("c_custkey")
    addr = address_from_key(k)
    entries = []
    for i, chain in enumerate(LABEL_DOC_CHAINS):
        entity = F.when(
            (k + i) % 3 == 0,
            F.struct(
                F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("type"),
                F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example")).alias("website"),
                F.when(k % 5 != 0, F.concat(F.lit("@"), k.cast("string"))).alias("twitter"),
            ),
        )
        label = F.when((k + i) % 4 == 0, F.struct(F.concat(F.lit(chain + "-"), F.col("c_mktsegment")).alias("name")))
        obj = F.struct(
            addr.alias("address"),
            ((k + i) % 2 == 0).alias(USER_KEY),
            entity.alias(ENTITY_KEY),
            label.alias(LABEL_KEY),
        )
        entries.append(F.when(k % (i + 2) == 0, F.struct(F.lit(chain).alias("key"), obj.alias("value"))))
    present = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return c.select(k.alias("k"), addr.alias("address"), F.to_json(F.map_from_entries(present)).alias("body"))


def saved_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot table of a saved key query: (run_ts, user_addr, c_custkey).

    Two runs are kept; the latest one selects ``c_acctbal >= 5000``.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    runs = None
    for ts, floor in RESULT_RUNS:
        run = cust.filter(F.col("c_acctbal") >= floor).select(
            F.to_timestamp(F.lit(ts)).alias("run_ts"),
            address_from_key(F.col("c_custkey")).alias("user_addr"),
            F.col("c_custkey"),
        )
        runs = run if runs is None else runs.unionByName(run)
    return runs


def result_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved-result rows as JSON objects with dynamic keys.

    ``user_addr`` is missing when ``k % 9 = 0`` and JSON null when ``k % 9 = 1``.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    with_key = F.to_json(
        F.struct(
            F.when(k % 9 != 1, address_from_key(k)).alias("user_addr"),
            F.col("c_mktsegment").alias("segment"),
        ),
        {"ignoreNullFields": "false"},
    )
    without_key = F.to_json(F.struct(F.col("c_mktsegment").alias("segment")))
    return cust.select(k.alias("row_id"), F.when(k % 9 == 0, without_key).otherwise(with_key).alias("row_json"))


def address_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, address) with broken addresses by ``k % 10``: 0 no prefix, 1 odd
    length, 2 non-hex letter, 3 upper-case hex (valid), else valid."""
    k = F.col("c_custkey")
    a = address_from_key(k)
    digits = F.substring(a, 3, 40)
    bad = (
        F.when(k % 10 == 0, digits)
        .when(k % 10 == 1, F.concat(a, F.lit("0")))
        .when(k % 10 == 2, F.concat(F.lit("0x"), F.substring(digits, 1, 39), F.lit("g")))
        .when(k % 10 == 3, F.concat(F.lit("0x"), F.upper(digits)))
        .otherwise(a)
    )
    return table(spark, sf_dir, "customer").select(k.alias("k"), bad.alias("address"))


def history_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as versions of a per-user document (key, ts, tie-break)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    return ev.select(
        F.col("user_id").alias("key"),
        F.col("ts").alias("version_ts"),
        F.col("event_id").alias("version_id"),
        F.to_json(F.struct("event_id", "value", "props")).alias("body"),
        "value",
        "props",
    )


def asof_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event: its user's version as of up to three days before or after the event."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    shift = F.expr("make_dt_interval(0, 0, 0, (event_id * 7919) % 518400 - 259200)")
    return ev.select(F.col("event_id").alias("request_id"), F.col("user_id").alias("key"), (F.col("ts") + shift).alias("as_of"))


def number_documents(spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    """A document per lineitem whose fields are JSON numbers: 41 digits, trailing zeros, an exponent
    beyond a double, and strings that look like numbers in JSON."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    li = li.withColumn("long", F.rpad(F.concat(F.lit("1"), F.col("l_orderkey").cast("string")), 41, "7")).withColumn("n", F.col("l_linenumber").cast("string"))
    address = F.concat(F.lit("0x"), F.lpad(F.concat("l_orderkey", F.lit("f"), "l_linenumber"), 40, "0"))
    if labels:
        body = F.format_string(
            '{"base":{"arkhamEntity":{"name":%s,"type":%s.0,"website":"a: %s.0 \\"x\\": -1.50, 2"},"arkhamLabel":%s}}',
            "long", "n", "n", F.when(F.col("l_linenumber") % 2 == 0, F.lit("0.0")).otherwise(F.concat(F.lit('{"name":'), "n", F.lit(".10}"))),
        )
    else:
        body = F.format_string(
            '{"ethereum":{"t%s":{"id":"t","name":"1.0","symbol":"S","balance":%s,"price": -%s.50,"usd":%se400}}}', "l_partkey", "long", "n", "n"
        )
    return li.select(address.alias("address"), body.alias("body"))


_LANDED: dict = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Derived documents landed once per session as parquet in the shared
    scratch area (the stand-in for a landed responses table), then read."""
    import os

    from walletflow.session import COMPACT, release_shuffles, scratch_path

    builders = {
        "portfolio": portfolio_documents,
        "portfolio_damaged": lambda s, d: damaged_portfolio_documents(s, d, landed(s, d, "portfolio")),
        "labels": label_documents,
        "saved_results": saved_results,
        "portfolio_pages": lambda s, d: portfolio_pages(s, d, PAGE_TOKENS),
    }
    key = (id(spark.sparkContext._jsc), sf_dir, name)
    path = _LANDED.get(key)
    local = path[5:] if path and path.startswith("file:") else path
    if path is None or ("://" not in local and not os.path.exists(local)):
        path = scratch_path(spark, f"docs-{name}")
        writer = builders[name](spark, sf_dir).write.options(**COMPACT)
        if name == "saved_results":
            writer = writer.partitionBy("run_ts")  # latest run found by partition pruning
        writer.parquet(path)
        del writer
        release_shuffles(spark, path)
        _LANDED[key] = path
    return spark.read.parquet(path)
