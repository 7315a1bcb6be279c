"""A1-A5: run statistics as DataFrames (global or per-round aggregates).

``wave_sketches`` keeps a row of fixed size per wave: a HyperLogLog sketch of the keys and a
KLL sketch of a measure (``elapsed_ms``).  Rows of waves, rounds and whole runs are added up
by ``merged_sketches`` without reading an attempt again; ``sketch_figures`` reads them.
Errors: distinct keys within 3 %, ranks of quantiles within 2 % (three and more standard
errors of ``HLL_BITS`` and ``KLL_SIZE``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HLL_BITS = 14   # standard error 0.8 %
KLL_SIZE = 400  # rank error 0.7 % at 99 % confidence


def wave_sketches(attempts: DataFrame, by: tuple = ("round", "wave"), key: str = "address", measure: str = "elapsed_ms") -> DataFrame:
    """One row per wave: counts and the two sketches; partial aggregates per task."""
    return attempts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if("ok").alias("succeeded"),
        F.hll_sketch_agg(key, HLL_BITS).alias("keys"),
        F.kll_sketch_agg_bigint(F.col(measure).cast("bigint"), KLL_SIZE).alias("measure"),
    )


def merged_sketches(sketches: DataFrame, by: tuple = ()) -> DataFrame:
    """The rows of many waves (of several runs) as one per group of ``by``."""
    return sketches.groupBy(*by).agg(
        F.sum("attempts").alias("attempts"),
        F.sum("succeeded").alias("succeeded"),
        F.hll_union_agg("keys").alias("keys"),
        F.kll_merge_agg_bigint("measure").alias("measure"),
    )


def sketch_figures(sketches: DataFrame, ranks: tuple = (0.5, 0.9, 0.99)) -> DataFrame:
    """Counts, estimated distinct keys and the measure's quantiles (``p50``, ...)."""
    others = [c for c in sketches.columns if c not in ("keys", "measure")]
    return sketches.select(
        *others,
        F.hll_sketch_estimate("keys").alias("distinct_keys"),
        *[F.kll_sketch_get_quantile_bigint("measure", F.lit(float(r))).alias(f"p{round(100 * r)}") for r in ranks],
    )


def round_stats(attempts: DataFrame) -> DataFrame:
    """A1: per round attempted / succeeded / failed."""
    return attempts.groupBy("round").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def status_counts(attempts: DataFrame) -> DataFrame:
    """K9: calls by outcome class."""
    return attempts.groupBy("status").agg(F.count(F.lit(1)).alias("calls"))


def batch_summary(keys: DataFrame, succeeded_keys: DataFrame, key: str = "address") -> DataFrame:
    """A2: total, succeeded, failed and success rate (%, 1 decimal) over the
    input keys, duplicates included (a duplicate of a fetched key counts as
    a success, like the reference's per-occurrence results).

    Keys are first reduced to (key, copies) – a partial aggregate, so a key
    repeated a billion times is one row before any join."""
    copies = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    ok = succeeded_keys.select(key).distinct().withColumn("_ok", F.lit(True))
    flagged = copies.join(ok, on=key, how="left")
    agg = flagged.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(F.when(F.col("_ok").isNotNull(), F.col("_copies"))), F.lit(0)).cast("bigint")
        .alias("succeeded"),
    )
    return agg.select(
        "total",
        "succeeded",
        (F.col("total") - F.col("succeeded")).alias("failed"),
        F.when(F.col("total") > 0, F.round(F.col("succeeded") * 100.0 / F.col("total"), 1))
        .cast("decimal(5,1)").alias("success_rate"),
    )
