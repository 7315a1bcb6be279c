"""Keys from the latest result of a saved query.

A saved query's results are kept as a snapshot table with a ``run_ts``
column (ideally partitioned by it, so the latest run is found by
partition pruning).  Extraction keeps the row order column, skips rows
lacking the key, keeps JSON nulls, and does not deduplicate.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_result(results: DataFrame, run_col: str = "run_ts") -> DataFrame:
    """Rows of the most recent run.

    The max is a scalar subquery, so it reaches the scan as a partition filter
    when the snapshots are partitioned by ``run_col``.
    """
    latest = results.agg(F.max(run_col).alias("latest"))
    return results.where(F.col(run_col) == latest.scalar())


def _member(js: Column, key: str) -> Column:
    """Text of a top-level member.  Keys that a JSON path cannot spell plainly are looked up."""
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", key):
        return F.get_json_object(js, f"$.{key}")
    return F.from_json(js, "map<string,string>")[key]


def column_values(rows: DataFrame, key: str, json_col: str | None = None) -> DataFrame:
    """Extract one column.

    * fixed-schema rows: ``select(key)`` (a missing column is an error);
    * JSON rows with dynamic keys (``json_col``): rows lacking ``key`` are
      skipped, a JSON null is kept as NULL.
    """
    if json_col is None:
        return rows.withColumn(key, F.col(key))
    js = F.col(json_col)
    present = F.coalesce(F.array_contains(F.json_object_keys(js), key), F.lit(False))
    return rows.filter(present).withColumn(key, _member(js, key))


def extract_stats(rows: DataFrame, key: str, json_col: str) -> DataFrame:
    """A5: total rows vs values extracted (and how many are non-null)."""
    js = F.col(json_col)
    present = F.coalesce(F.array_contains(F.json_object_keys(js), key), F.lit(False))
    value = _member(js, key)
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(present).alias("values_extracted"),
        F.count_if(present & value.isNotNull()).alias("non_null_values"),
    )
