"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletflow.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"  # fixed: words are runs without ASCII white space
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(module_name: str) -> None:
    """Send the module's functions to the Python workers by value, so executors
    need no copy of this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def barrier(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns through a one-element generator: each is computed once per row,
    and later lambdas and projections read the value instead of inlining it."""
    names = list(exprs)
    one = F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))
    return df.select("*", F.inline(one).alias(*names))


def numbered(df: DataFrame) -> DataFrame:
    """The columns under the names in0, in1, ..., which clash with nothing."""
    return df.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(df.columns)])


def slices(batches, budget: int, column: str):
    """Cut Arrow batches so that the texts of one piece hold at most ``budget``
    bytes (a longer text is a piece of its own)."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(size):
            if i > start and held + n > budget:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
