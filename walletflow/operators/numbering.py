"""Gap-free sequential numbering 1..n over a total order, at scale.

``row_number() over (order by ...)`` without a partition moves every row
into one task.  Instead:

1. range-partition by the order key and sort within partitions (one
   shuffle, spread over all tasks);
2. tag rows with ``monotonically_increasing_id`` (partition index in the
   upper bits, position in the lower 33 bits) and checkpoint, so the tags
   are computed exactly once;
3. count rows per partition (one row per partition), turn the counts into
   start offsets, and broadcast that table – its size is the number of
   partitions, a fixed bound;
4. ``no = offset + position + 1``.

Range partitioning cannot split equal keys, so the order key should be
unique (add a tie-breaker column) to keep a hot value from landing in one
partition.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletflow.session import checkpoint_root


def dense_number(df: DataFrame, order: list, name: str = "no", partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys: list[Column] = [F.col(c) if isinstance(c, str) else c for c in order]
    # The range sampler and the shuffle both read the input; persisting it
    # keeps it from being computed twice (lost blocks are recomputed).
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tagged = (
            src.repartitionByRange(n, *keys)
            .sortWithinPartitions(*keys)
            .withColumn("_rid", F.monotonically_increasing_id())
            .checkpoint(eager=True)
        )
    finally:
        src.unpersist()
    part = F.shiftright(F.col("_rid"), 33)
    counts = tagged.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = tagged.join(F.broadcast(offsets), part == F.col("_pid"))
    position = F.col("_rid") - F.shiftleft(part, 33)
    return numbered.select(*[F.col(c) for c in df.columns], (F.col("_off") + position + 1).alias(name))
