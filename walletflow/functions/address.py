"""Address expressions: key -> address text, text -> binary, request path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from walletflow.schemas import LABEL_PATH, PORTFOLIO_PATH


def address_from_key(k: Column) -> Column:
    """'0x' + 40 lower-case hex digits of a non-negative integer key."""
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(k)), 40, "0"))


def address_problem(a: Column) -> Column:
    """Why an address cannot be loaded as binary, or NULL when it can.

    ``try_to_binary(..., 'hex')`` alone accepts odd lengths (it left-pads a
    zero), so the prefix, the parity and the digit set are checked here.
    """
    return (
        F.when(a.isNull(), F.lit("null address"))
        .when(~a.startswith("0x"), F.lit("missing 0x prefix"))
        .when(F.length(a) % 2 == 1, F.lit("odd number of hex digits"))
        .when(~a.rlike("^0x[0-9a-fA-F]*$"), F.lit("non-hex character"))
    )


def address_to_binary(a: Column) -> Column:
    """Binary form of a valid address, NULL otherwise."""
    return F.when(address_problem(a).isNull(), F.try_to_binary(F.substring(a, 3, 1 << 30), F.lit("hex")))


def endpoint_path(kind: str, a: Column) -> Column:
    """Request path of the label or portfolio endpoint for an address."""
    pattern = {"labels": LABEL_PATH, "portfolio": PORTFOLIO_PATH}[kind].replace("{}", "%s")
    return F.format_string(pattern, a)
