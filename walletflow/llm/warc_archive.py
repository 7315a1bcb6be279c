"""WARC archives as a chunked record table.

Writing: payloads of at least ``LEAST`` bytes are keyed by their SHA-256; the
page with the smallest id keeps the payload, the others become revisit records.
A payload over ``CHUNK`` bytes is stored as segments (the format's own
continuation records), one row per record identifier and chunk number.  Lines
are written by Spark's text writer with the record end as separator, gzipped,
so any file system that Spark reaches will do, and a lost task's file is
written anew.

Reading: Spark's text reader cuts where a record's end meets the next record's
start.  A payload is also cut inside every ``WARC/1.0`` that it holds, so no block
holds that text, and neither a block nor a block with the line ends around it can
look like a record's start.  Blocks are rows made one by one from the page's bytes;
no second copy of a payload is built.  Single records are digested where they are;
chunk rows go to their record's task in chunk order, which carries one running
digest per record - no task builds a whole payload.  Anything between records
that is no record stops the read.

Defined results: null html is an empty payload; a null url leaves out the
target line; a null ``page_id`` is kept, is never the one that others refer to
unless no page with that payload has an id (then all are responses); repeated
rows with the smallest id are all responses; extra columns are ignored; an
empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletflow.llm.common import barrier, ship
from walletflow.session import scratch_path

ship(__name__)

LEAST = 100  # fixed: bytes from which equal payloads are stored once
CHUNK = 64 << 10  # bytes of payload in one segment
RECORDS = 8192  # most records in one archive file
VERSION = "WARC/1.0"
START = VERSION + "\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"  # the tables hold no fetch time


def _header(name: str, value: Column) -> Column:
    """``Name: value`` and a line end; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _uri(name: str, *parts) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(name), *[p.cast("string") for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12)), F.lit(">"))


def page_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, bytes, digest, kind, refers): one row per page."""
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select("page_id", "url", html.alias("payload"), F.octet_length(html).cast("long").alias("bytes"))
    own = own.withColumn("digest", F.sha2("payload", 256))
    shared = (
        own.where(F.col("bytes") >= LEAST)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    both = own.join(shared, "digest", "left")
    again = F.col("refers").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers"))
    return both.select(
        "page_id", "url", "payload", "bytes", "digest",
        F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("refers")).alias("refers"),
    )


def _starts(payload: Column, size: int) -> Column:
    """Where the payload's blocks start: every ``size`` bytes, and inside every version mark."""
    even = F.sequence(F.lit(0).cast("long"), F.greatest(F.octet_length(payload) - 1, F.lit(0)).cast("long"), F.lit(size).cast("long"))
    parts = F.split(payload, r"(?<=WAR)(?=C/1\.0)", -1)
    marks = F.aggregate(
        F.transform(parts, lambda p: F.octet_length(p).cast("long")),
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("out")),
        lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        lambda a: a["out"],
    )
    return F.when(F.contains(payload, F.lit(VERSION)), F.array_sort(F.array_union(even, marks))).otherwise(even)


def write_archive(pages: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """Write one WARC record per page (and one per further chunk) below ``path``."""
    at = F.monotonically_increasing_id()
    rows = page_records(pages).withColumn("record", _uri("record", at))
    stored = F.col("kind") == "response"
    rows = barrier(
        rows,
        data=F.when(stored, F.col("payload").cast("binary")).otherwise(F.lit(b"")),
        starts=F.when(stored, _starts(F.col("payload"), chunk)).otherwise(F.array(F.lit(0).cast("long"))),
    )
    cuts = F.transform("starts", lambda s, i: F.struct(i.alias("k"), s.alias("first"), F.get("starts", i + 1).alias("upto")))
    rows = barrier(rows.drop("payload"), cuts=cuts)
    # the blocks are cut while the rows are generated: the page's bytes are not copied to each of them
    rows = rows.select("page_id", "url", "bytes", "digest", "kind", "refers", "record", "data", F.size("starts").alias("segments"), F.inline("cuts"))
    size = F.coalesce(F.col("upto"), F.octet_length("data").cast("long")) - F.col("first")
    rows = rows.withColumn("block", F.substring("data", (F.col("first") + 1).cast("int"), size.cast("int")))
    cut, first = F.col("segments") > 1, F.col("k") == 0
    block = F.concat(F.when(first, F.lit(HTTP)).otherwise(F.lit("")), F.col("block").cast("string"))
    safe_url = F.regexp_replace("url", r"[\r\n]", " ")
    line = F.concat(
        F.lit(START),
        _header("WARC-Type", F.when(first, F.col("kind")).otherwise(F.lit("continuation"))),
        _header("WARC-Record-ID", F.when(first, F.col("record")).otherwise(_uri("segment", F.col("record"), F.col("k")))),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", safe_url),
        F.when(F.col("kind") == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Segment-Number", F.when(cut, F.col("k") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(~first, F.col("record"))),
        _header("WARC-Segment-Total-Length", F.when(cut & (F.col("k") + 1 == F.col("segments")), F.col("bytes") + len(HTTP))),
        _header("X-Page-Id", F.col("page_id")),
        _header("X-Payload-Length", F.col("bytes")),
        _header("X-Refers-To-Page", F.col("refers")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )
    lines = rows.select(line.alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


def chunk_table(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: (record, chunk, segments, kind, page_id, digest, bytes, refers, block)."""
    raw = spark.read.schema("value string").option("lineSep", END + START).text(path)
    head = F.substring_index("value", END, 1)
    raw = raw.select("value", F.concat(F.lit("\r\n"), head, F.lit("\r\n")).alias("head"), (F.octet_length(head) + 5).alias("at"))

    def field(name: str) -> Column:
        got = F.regexp_extract("head", rf"\r\n{name}: ([^\r]*)\r\n", 1)
        return F.when(got != "", got)

    kind, chunk = field("WARC-Type"), F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1))
    skip = F.when(kind == "continuation", 0).otherwise(len(HTTP))
    # what lies between two marks is a record or nothing but line ends
    record = F.when(F.contains("head", F.lit("\r\nWARC-Record-ID: ")), F.lit(True)).when(
        F.trim(F.translate("value", "\r\n", "  ")) == "", F.lit(False)
    ).otherwise(F.raise_error(F.concat(F.lit("no WARC record: "), F.substring("value", 1, 100))).cast("boolean"))
    return raw.where(record).select(
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("record"),
        chunk.alias("chunk"),
        F.contains("head", F.lit("\r\nWARC-Segment-Number: ")).alias("cut"),
        kind.alias("kind"),
        field("X-Page-Id").alias("page_id"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("digest"),
        field("X-Payload-Length").cast("long").alias("bytes"),
        field("X-Refers-To-Page").alias("refers"),
        F.substring(
            F.col("value").cast("binary"), (F.col("at") + skip).cast("int"), (field("Content-Length").cast("long") - skip).cast("int")
        ).alias("block"),
    )


def running_digests(batches):
    """Chunk rows in order -> (record, chunk, upto, digest): bytes and digest so far."""
    import hashlib

    import pyarrow as pa

    record, state, upto = None, None, 0
    for batch in batches:
        out = []
        for r, k, block in zip(batch.column("record").to_pylist(), batch.column("chunk").to_pylist(), batch.column("block")):
            if r != record:
                record, state, upto = r, hashlib.sha256(), 0
            data = block.as_buffer()
            state.update(data)
            upto += len(data)
            out.append((r, k, upto, state.hexdigest()))
        if out:
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["record", "chunk", "upto", "digest"])


def chunk_digests(chunks: DataFrame) -> DataFrame:
    """(record, chunk, upto, digest) of chunk rows; a record's chunks meet in one task, in order."""
    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = chunks.select("record", "chunk", "block").repartition(n, "record").sortWithinPartitions("record", "chunk")
    return rows.mapInArrow(running_digests, "record string, chunk int, upto long, digest string")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id as text, kind, payload_bytes, payload_digest, refers): one row per page, from the
    stored bytes; a revisit's figures are those its record states."""
    table = chunk_table(spark, path)
    again = F.col("kind") == "revisit"
    single = table.where(~F.col("cut")).select(
        "page_id", "kind",
        F.when(again, F.col("bytes")).otherwise(F.octet_length("block").cast("long")).alias("payload_bytes"),
        F.when(again, F.col("digest")).otherwise(F.sha2("block", 256)).alias("payload_digest"),
        "refers",
    )
    parts = table.where("cut")
    whole = chunk_digests(parts).groupBy("record").agg(F.max("upto").alias("payload_bytes"), F.max_by("digest", "chunk").alias("payload_digest"))
    named = parts.where("chunk = 1").select("record", "page_id", "kind", "refers")
    return single.unionByName(named.join(whole, "record").select("page_id", "kind", "payload_bytes", "payload_digest", "refers"))


def archive_report(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Write the archive to the shared folder and read it back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages.select("page_id", "url", "html"), path, chunk)
    kind = dict(pages.dtypes)["page_id"]
    return read_archive(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("kind").alias("record_type"), F.col("refers").cast(kind).alias("refers_to"),
    )
