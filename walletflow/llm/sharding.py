"""Uniform shuffle into exactly sized shards (DataFrame functions only).

1. *Permute locally*: every input partition is sorted by a random key; partition
   number and position are written down with the rows in the shared folder, so
   a lost executor cannot change them.
2. *Communication matrix*: from the partition sizes n_p and the shard sizes m_s
   (rows spread evenly, the remainder to the first shards) the matrix of counts
   partition -> shard is drawn from its exact distribution, the multivariate
   hypergeometric one, row by row.  It has (partitions x shards) integers and
   never depends on rows.  A row's local position selects its shard.
3. *Exchange* by (shard, bucket), where the bucket is the top of a second random
   key; bucket counts come from the slim columns.
4. *Permute again*: position by the second key inside the bucket, after the
   smaller buckets of the shard: gapless slots, and every order equally likely.

Each row's whole content crosses the network once.  Keys are random per row
(not per value), so a third of all rows being equal moves no load.

Defined results: null texts and ids are ordinary values; repeated rows each get
a slot; extra columns are carried in one struct, so names cannot clash; with
fewer rows than shards the last shards stay empty; an empty table gives an
empty table.  The draw is repeatable for a given ``seed`` and input layout.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletflow.llm.common import stored

BUCKET_ROWS = 4096  # mean rows that one task orders at once
BROADCAST_ROWS = 200_000  # matrix rows (24 longs each, 40 MB) up to which it is broadcast
INDEX_BITS = 33  # monotonically_increasing_id: partition number above 33 bits of position


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    return np.full(shards, rows // shards, dtype=np.int64) + (np.arange(shards) < rows % shards)


def communication_matrix(partition_rows, shards: int, seed: int) -> np.ndarray:
    """Exact draw: row p holds how many rows of partition p go to each shard."""
    rng = np.random.default_rng(seed)
    left = shard_sizes(int(sum(partition_rows)), shards)
    out = np.zeros((len(partition_rows), shards), dtype=np.int64)
    for p, n in enumerate(partition_rows):
        out[p] = _row(rng, left, int(n))
        left -= out[p]
    return out


def _row(rng, left: np.ndarray, n: int) -> np.ndarray:
    """Multivariate hypergeometric draw by halving the shards."""
    if len(left) == 1:
        return np.array([n], dtype=np.int64)
    half = len(left) // 2
    first = _good(rng, int(left[:half].sum()), int(left[half:].sum()), n)
    return np.concatenate([_row(rng, left[:half], first), _row(rng, left[half:], n - first)])


def _good(rng, good: int, bad: int, n: int) -> int:
    """How many of n items taken from good + bad are good.  numpy's draw holds below
    10^9 items a side; above, the distribution is summed outwards from its mode."""
    if not n or not good:
        return 0
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    reach = int(12 * (n * good / (good + bad) * bad / (good + bad)) ** 0.5) + 40
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    steps = np.log((good - k[:-1]) * (n - k[:-1])) - np.log((k[:-1] + 1) * (bad - n + k[:-1] + 1))
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    weight = np.cumsum(np.exp(weight - weight.max()))
    return int(k[np.searchsorted(weight, rng.random() * weight[-1], side="right")])


def _local(docs: DataFrame, seed: int) -> DataFrame:
    """(row, part, pos): rows in random order inside their input partition, stored."""
    at = F.monotonically_increasing_id()
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.lit(seed), at).alias("key"))
    rows = rows.sortWithinPartitions("key").select("row", at.alias("at"))
    return stored(
        rows.select(
            "row",
            F.shiftright("at", INDEX_BITS).alias("part"),
            F.col("at").bitwiseAND(F.lit((1 << INDEX_BITS) - 1)).alias("pos"),
        ),
        "shard-local",
    )


def _second_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed + 1), "part", "pos")


def shuffle_into_shards(docs: DataFrame, shards: int = 24, seed: int = 42) -> DataFrame:
    """(row, shard, slot): every input row as a struct, its shard and its place there."""
    spark = docs.sparkSession
    local = _local(docs, seed)
    sizes = sorted((r["part"], r["n"]) for r in local.groupBy("part").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in sizes)
    matrix = communication_matrix([n for _, n in sizes], shards, seed)
    rows = [(p, [int(x) for x in np.cumsum(m)]) for (p, _), m in zip(sizes, matrix)]
    cells = spark.createDataFrame(rows, "part long, upto array<long>")
    if len(rows) <= BROADCAST_ROWS:
        cells = F.broadcast(cells)
    buckets = max(1, -(-total // (shards * BUCKET_ROWS)))
    bucket = F.pmod(F.shiftrightunsigned(_second_key(seed), 1), F.lit(buckets))

    def placed(*columns):
        return (
            local.select("part", "pos", *columns)
            .join(cells, "part")
            .select(
                *columns, "part", "pos",
                F.size(F.filter("upto", lambda u: u <= F.col("pos"))).alias("shard"),
                bucket.alias("bucket"), _second_key(seed).alias("key"),
            )
        )

    counts = placed().groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "part", "pos")
    ranked = placed("row").select("row", "shard", "bucket", (F.row_number().over(inside) - 1).cast("long").alias("rank"))
    return ranked.join(offsets, ["shard", "bucket"]).select("row", "shard", (F.col("first") + F.col("rank")).alias("slot"))


def shard_report(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document under the law of equal row counts."""
    done = shuffle_into_shards(docs.select("doc_id", "text"), shards)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
