"""Incremental load of landed fetch rounds (K7 + T6 as a stream).

Fetch rounds land their attempts in ``<landing>/round=<r>``.  A file
stream over the landing folder picks up each new round once, keeps the
successes, flattens them with the same Catalyst expressions as the batch
path, and appends them to a table in ``foreachBatch``.  The stream's
checkpoint (in the shared checkpoint folder) records which files were
loaded.  A batch is appended under the load id ``<stream>-<epoch>``, which
becomes visible together with its rows: an epoch that is repeated because the
driver died before the checkpoint's commit finds its load and adds nothing.
(A table that was not made by ``create_table`` has no load ids; there a repeated
epoch is appended again.)
``trigger(availableNow=True)`` loads what is there and stops, which suits a
job that runs after (or between) fetch rounds.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from walletflow.operators import labels as L
from walletflow.operators import portfolio as P
from walletflow.operators.fetch import LANDED_SCHEMA
from walletflow.session import scratch_path
from walletflow.sinks.tables import append_once, has_versions


def landed_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(landing)


def flatten_landed(stream: DataFrame, kind: str) -> DataFrame:
    ok = stream.filter("ok").select("address", "round", "body")
    if kind == "labels":
        return L.flatten_labels(L.parse_labels(ok), keep=["round"])
    return P.flatten_portfolio(P.parse_portfolio(ok), keep=["round"])


def load_landed(spark: SparkSession, landing: str, kind: str, table: str,
                checkpoint: str | None = None) -> StreamingQuery:
    """Start an availableNow stream appending flattened successes to ``table``
    (which must exist with the flattened columns, by name)."""
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    cols = [f.name for f in spark.table(table).schema.fields]
    versioned = has_versions(spark, table)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def append(batch: DataFrame, epoch: int) -> None:
        if versioned:
            append_once(batch.sparkSession, batch, table, f"{stream}-{epoch}")
        else:
            batch.select(*cols).write.insertInto(table)

    flat = flatten_landed(landed_stream(spark, landing), kind)
    return (
        flat.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_landed_now(spark: SparkSession, landing: str, kind: str, table: str,
                    checkpoint: str | None = None) -> None:
    """Run ``load_landed`` to completion and refresh the caller's view of
    the table (the batches were written from the stream's session)."""
    load_landed(spark, landing, kind, table, checkpoint).awaitTermination()
    spark.catalog.refreshTable(table)
