"""Packing by power-of-two decomposition.

A document's ids and the closing id are cut into pieces whose lengths are the
binary digits of its length (as many pieces of ``limit`` as fit, then one piece
for each bit, longest first).  Equal lengths form a bucket; every piece is a
sequence of its own, so no sequence crosses documents and none is padded.
Batches are then drawn from one bucket at a time.

Tokenising runs in Arrow batches, cut to a few MB of text, with the vocabulary's
rank file: the same ids as the tokenizer file, at three times its speed.

Pieces are written to the shared folder with their place in the task; sequence
numbers are gapless, bucket after bucket, from the (bucket, task) counts - a
table of 12 x tasks rows - so they need no ordering of all pieces.

Defined results: a null text is empty: one piece, the closing id; a null
``doc_id`` is kept; repeated rows are packed each; extra columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletflow.llm.common import ship, slices, stored

ship(__name__)
ship("walletflow.llm.common")

LIMIT = 2048  # fixed: longest sequence
END = 1  # fixed: id after every document
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed: the pattern's white space
LONG_SPACE = 10_000
TEXT_BYTES = 4 << 20  # text handled at once
INDEX_BITS = 33
BROADCAST_ROWS = 500_000  # (bucket, task) counts of 32 bytes up to which they are broadcast


def binary_pieces(length: int, limit: int = LIMIT) -> list[int]:
    """Piece lengths of a document, longest first."""
    rest = length % limit
    return [limit] * (length // limit) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def make_encoder(rank_file: str, pattern: str, special: dict):
    """text -> little-endian unsigned 32-bit ids, equal to the tokenizer's own."""
    import base64
    import re

    import numpy as np
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    long_space = re.compile("[" + SPACE + "]{%d,}" % LONG_SPACE)

    def by_spaces(text: str):
        """The pattern engine's stack does not hold very long white space: such runs are pieces of
        their own, up to the last character, which belongs to what follows."""
        at = 0
        for run in long_space.finditer(text):
            last = run.end() == len(text) or any(text.startswith(s, run.end()) for s in special)
            end = run.end() if last else run.end() - 1
            yield coder.encode_to_numpy(text[at:run.start()], allowed_special="all")
            yield whole.encode_to_numpy(text[run.start():end], disallowed_special=())
            at = end
        yield coder.encode_to_numpy(text[at:], allowed_special="all")

    def encode(text: str) -> bytes:
        try:
            ids = coder.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            ids = np.concatenate(list(by_spaces(text)))
        return ids.astype("<u4", copy=False).tobytes()

    return encode


def tokenised(docs: DataFrame, rank_file: str, pattern: str, special: dict, text: str = "text") -> DataFrame:
    """(doc_id, ids): binary little-endian ids of the whole text, closing id included."""

    def run(batches):
        import pyarrow as pa

        encode = make_encoder(rank_file, pattern, special)
        end = END.to_bytes(4, "little")
        for piece in slices(batches, TEXT_BYTES, "text"):
            ids = [encode(t or "") + end for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def pack_binary(tokens: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset), ids as bytes."""
    total = (F.octet_length("ids") / 4).cast("long")
    full = F.floor(F.col("doc_tokens") / limit)
    rest = F.col("doc_tokens") % limit
    bits = [1 << b for b in range(limit.bit_length() - 2, -1, -1)]
    pieces = F.concat(
        F.when(full > 0, F.transform(F.sequence(F.lit(0).cast("long"), full - 1), lambda i: F.struct((i * limit).alias("start"), F.lit(limit).cast("long").alias("length"))))
        .otherwise(F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")),
        F.array_compact(F.array(*[
            # the larger bits come first: start is all of the length above this bit
            F.when(rest.bitwiseAND(F.lit(b)) > 0, F.struct((F.col("doc_tokens") - rest % (2 * b)).alias("start"), F.lit(b).cast("long").alias("length")))
            for b in bits
        ])),
    )
    cut = tokens.select("doc_id", "ids", total.alias("doc_tokens")).select("doc_id", "ids", "doc_tokens", F.explode(pieces).alias("p"))
    at = F.monotonically_increasing_id()
    rows = stored(
        cut.select(
            "doc_id", F.col("p.start").alias("start"), F.col("p.length").alias("length"),
            F.substring("ids", (F.col("p.start") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int")).alias("ids"),
            "doc_tokens", F.log2("p.length").cast("int").alias("bucket"),
        )
        .sortWithinPartitions("bucket")
        .withColumn("at", at),
        "packed-pieces",
    ).withColumn("task", F.shiftright("at", INDEX_BITS))
    sizes = rows.groupBy("bucket", "task").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    inside = Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    below = sizes.groupBy("bucket").agg(F.sum("n").alias("m"))
    before = below.alias("a").join(F.broadcast(below.alias("b")), F.col("b.bucket") < F.col("a.bucket"), "left").groupBy(F.col("a.bucket").alias("bucket")).agg(
        F.coalesce(F.sum("b.m"), F.lit(0)).alias("first")  # 12 buckets at most
    )
    first = sizes.select("bucket", "task", "low", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("skip")).join(F.broadcast(before), "bucket")
    if sizes.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    return rows.join(first, ["bucket", "task"]).select(
        "doc_id", "start", "length", "ids", "doc_tokens", "bucket",
        (F.col("first") + F.col("skip") + F.col("at") - F.col("low")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def packing_report(docs: DataFrame, rank_file: str, pattern: str, special: dict) -> DataFrame:
    packed = pack_binary(tokenised(docs, rank_file, pattern, special))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
