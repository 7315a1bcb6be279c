"""S3/S4 over landed data: documents already stored in a table.

* ``lookup``: a left equi-join of the keys with the landed documents;
  unmatched keys become failures with the reference's error text (K12).
* ``as_of``: latest version per key at or before a time.  ``ts <= t`` is
  pushed into the scan; ``max_by`` over ``(ts, id)`` is a partial
  aggregate, so a hot key is reduced map-side before the shuffle.
* ``as_of_requests``: the latest version at or before each request's own time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(keys: DataFrame, landed: DataFrame, no_data_message: str,
           key: str = "address", body: str = "body") -> DataFrame:
    """keys ⋈left landed -> key, body, is_success, error_message."""
    joined = keys.join(landed.select(key, body), on=key, how="left")
    return joined.select(
        "*",
        F.col(body).isNotNull().alias("is_success"),
        F.when(F.col(body).isNull(), F.lit(no_data_message)).alias("error_message"),
    )


def as_of(history: DataFrame, when: Column, key: str = "key", ts: str = "version_ts",
          tie: str = "version_id") -> DataFrame:
    """One row per key: the version with the greatest (ts, tie) with ts <= when."""
    cols = [c for c in history.columns if c != key]
    latest = (
        history.filter(F.col(ts) <= when)
        .groupBy(key)
        .agg(F.max_by(F.struct(*cols), F.struct(F.col(ts), F.col(tie))).alias("v"))
    )
    return latest.select(key, *[F.col(f"v.{c}").alias(c) for c in cols])


def as_of_requests(history: DataFrame, requests: DataFrame, key: str = "key", ts: str = "version_ts",
                   tie: str = "version_id", at: str = "as_of", bucket_seconds: int = 3600,
                   fan_out: int = 1024) -> DataFrame:
    """Every row of ``requests`` (with ``key`` and a time ``at``) and the columns of its version: the one
    with the greatest (ts, tie) with ts <= at, NULLs where the key has none yet.

    Time is cut into buckets.  Inside a bucket a window over (key, bucket) finds the last version before
    each request.  Requests before their bucket's first version take the last version of an earlier
    bucket: of the same group of ``fan_out`` buckets, else of an earlier group.  No window holds more of
    a key than one bucket, one group's buckets or the key's groups, so a hot key is spread over its
    buckets.  Only (ts, tie) goes through the windows; the version's other columns are joined at the end.

    A request with a null key or time matches nothing; repeated requests are answered each; (ts, tie) is
    expected once per key.  ``history`` and ``requests`` share no column but ``key``.
    """
    rest = [c for c in history.columns if c not in (key, ts, tie)]
    second = F.unix_seconds(F.col("_at").cast("timestamp"))
    versions = history.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), F.col(ts).alias("_at"), F.struct(F.col(ts).alias("ts"), F.col(tie).alias("tie")).alias("_version")
    )
    asked = requests.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("_key"), F.col(at).alias("_at")).distinct()
    both = versions.withColumn("_asked", F.lit(False)).unionByName(
        asked.select("_key", "_at", F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"), F.lit(True).alias("_asked"))
    )
    bucket, group = F.floor(second / bucket_seconds).alias("_bucket"), F.floor(second / (bucket_seconds * fan_out)).alias("_group")
    both = both.select("*", bucket, group)
    # versions of a time come before its requests; they are ordered by the tie-break
    inside = Window.partitionBy("_key", "_group", "_bucket").orderBy("_at", "_asked", "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.select("_key", "_group", "_bucket", "_at", "_asked", F.max("_version").over(inside).alias("_own")).where("_asked")
    lasts = both.groupBy("_key", "_group", "_bucket").agg(F.max("_version").alias("_last"))
    earlier = Window.partitionBy("_key", "_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_group = lasts.select("_key", "_group", "_bucket", F.max("_last").over(earlier).alias("_before"))
    groups = lasts.groupBy("_key", "_group").agg(F.max("_last").alias("_last"))
    sooner = Window.partitionBy("_key").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    by_group = groups.select("_key", "_group", F.max("_last").over(sooner).alias("_long_before"))
    carried = in_group.join(by_group, ["_key", "_group"]).select(
        "_key", "_group", "_bucket", F.coalesce("_before", "_long_before").alias("_carried")
    )
    answers = found.join(carried, ["_key", "_group", "_bucket"]).select("_key", "_at", F.coalesce("_own", "_carried").alias("_found"))
    answers = answers.select("_key", "_at", F.col("_found.ts").alias("_ts"), F.col("_found.tie").alias("_tie"))
    named = requests.join(answers, (F.col(key) == F.col("_key")) & (F.col(at) == F.col("_at")), "left").drop("_key", "_at")
    payload = history.select(F.col(key).alias("_key"), F.col(ts), F.col(tie), *rest)
    return named.join(
        payload, (F.col(key) == F.col("_key")) & (F.col("_ts") == F.col(ts)) & (F.col("_tie") == F.col(tie)), "left"
    ).drop("_key", "_ts", "_tie")
