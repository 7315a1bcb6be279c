"""Schemas and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Label primary-chain priority, highest first.
PRIORITY_CHAINS = ["ethereum", "arbitrum_one", "polygon", "optimism", "base", "bsc"]
# Portfolio networks that are exported, in output order.
EXPORT_CHAINS = ["arbitrum_one", "ethereum", "base", "optimism"]
# Display rename applied to exported portfolio networks.
CHAIN_RENAME = {"arbitrum_one": "arbitrum"}
# Label entity fields and JSON keys.
ENTITY_FIELDS = ["name", "type", "website", "twitter", "crunchbase", "linkedin"]
ENTITY_KEY = "arkhamEntity"
LABEL_KEY = "arkhamLabel"
USER_KEY = "isUserAddress"
# Portfolio token keys, all required.
TOKEN_FIELDS = ["id", "name", "symbol", "balance", "price", "usd"]
# Error text of a failed lookup.
LABEL_NO_DATA = "API returned no data"
PORTFOLIO_NO_DATA = "API returned no portfolio data"
# Request paths.
LABEL_PATH = "/intelligence/address/{}/all"
PORTFOLIO_PATH = "/portfolio/address/{}"
# Default file name prefixes.
LABEL_FILE_PREFIX = "ArcHam_Intelligence_Report_"
PORTFOLIO_FILE_PREFIX = "ArcHam_portfolios_"
# CSV column layouts.
LABEL_COLUMNS = [
    "no", "address", "name", "type", "label", "isuseraddress",
    "website", "twitter", "crunchbase", "linkedin", "update_date",
]
PORTFOLIO_COLUMNS = ["chain", "address", "symbol", "balance", "price", "usd"]
# Flat label record (to_dict order).
LABEL_RECORD_FIELDS = [
    "address", "name", "type", "website", "twitter",
    "crunchbase", "linkedin", "label", "isUserAddress",
]
# Service limits (defaults of the reference).
DEFAULT_THREADS = 5
DEFAULT_REQUEST_DELAY = 0.07
DEFAULT_MAX_ROUNDS = 10
DEFAULT_ROUND_DELAY = 2.0
DEFAULT_BACKOFF_429 = 2.0
DEFAULT_TIMEOUT = 15.0
# ---------------------------------------------------------------------------

TOKEN_DDL = "struct<" + ",".join(f"{f}:string" for f in TOKEN_FIELDS) + ">"
PORTFOLIO_DDL = f"map<string,map<string,{TOKEN_DDL}>>"
LOOSE_MAP_DDL = "map<string,variant>"

LABEL_TABLE_SCHEMA = T.StructType([
    T.StructField("no", T.IntegerType()),
    T.StructField("address", T.BinaryType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("isuseraddress", T.BooleanType()),
    T.StructField("website", T.StringType()),
    T.StructField("twitter", T.StringType()),
    T.StructField("crunchbase", T.StringType()),
    T.StructField("linkedin", T.StringType()),
    T.StructField("update_date", T.DateType()),
])

PORTFOLIO_TABLE_SCHEMA = T.StructType([
    T.StructField("chain", T.StringType()),
    T.StructField("address", T.BinaryType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("balance", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("usd", T.StringType()),
])


def text_schema(columns: list[str]) -> T.StructType:
    """All-string schema used to read CSV text before typing it."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
