"""Evaluate an expensive expression once per row.

A Filter on an aliased column is pushed below its Project with the alias
substituted, so a filter on "document is valid" would re-run the JSON
parse that the projection runs again.  Producing the value through a
one-element generator keeps later filters above it: the parse runs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return df.select("*", F.explode(F.array(expr)).alias(name))
