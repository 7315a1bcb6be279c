"""Prefix trie of conversations, screened by a count-min sketch.

Conversations are rebuilt: each takes the first turns of the conversation its id
points to, then its own turns after as many.  Only a turn's two 64-bit hashes and
its length travel, never its text.  A prefix's digest is 128 bits: the running
XOR of its turns' hashes, each mixed with its depth.

Screening: the digests of all prefixes are counted in ``ROWS`` rows of cells; a
cell only tells none, one or more.  The cells of two or more go to the tasks as
bitmaps (``MOST_CELLS`` bits a row at most, 16 MB in all).  A prefix of which one
cell holds one is proven to be of one conversation: its node, the tail of that
conversation, is written where it is read.  Only prefixes that may be shared are
shuffled and grouped exactly; a wrong "may be" costs a shuffled row, no result.

Sums over subtrees need no walk: the prefixes of a conversation that it does not
own (own: be the smallest member) are its first ones, so a node's leaves, children
and saved tokens are sums over its members of figures that each conversation knows
once its first owned depth is known.  Two groupings do, at any depth of the trie.

Hot keys: turns are put in order and prefix digests are built in pieces of
``PIECE`` turns, a conversation of more turns is numbered by range partitions;
groups of copies are partial aggregates, and their sorted member lists are cut by
``PIECE`` ids.  SHA-256 reads one list front to back, so the pieces of one node's
list pass through one task as a stream, one piece in memory at a time.

Defined results: turns with equal ``turn`` follow by their hashes; repeated rows
are turns of their own; rows with a null ``conv_id`` belong to no conversation;
null role and text are empty; ids below zero point to the multiple of five
towards zero; extra columns are ignored; an empty table has no nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletflow.llm.common import ship, stored
from walletflow.operators.numbering import dense_number

ship(__name__)

PIECE = 4096  # turns of one window, ids of one member list
ROWS = 4  # rows of the sketch
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 25  # cells of a row
SEGMENT = 1 << 16  # cells of a row that one task counts at once
FAMILY, HEADS = 5, 9  # fixed: ids of one family share their first turns, at most HEADS - 1


def _mixed(name: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "depth", "a", "b").alias(name)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, a, b, bytes): the turns' places from 1, hashes and lengths of their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    turns = stored(turns, "trie-turns")
    order = [F.asc_nulls_first("turn"), F.col("a"), F.col("b")]
    long = stored(turns.groupBy("conv_id").count().where(F.col("count") > PIECE).select("conv_id"), "trie-long")
    columns = ["conv_id", "i", "a", "b", "bytes"]
    if long.isEmpty():
        return turns.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long")).select(*columns)
    short = turns.join(long, "conv_id", "left_anti")
    short = short.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    # equal turns of a long conversation may lie in different partitions: any order of them is the same
    rest = turns.join(long, "conv_id", "left_semi").withColumn("at", F.monotonically_increasing_id())
    numbered = dense_number(rest, [F.col("conv_id"), *order, F.col("at")], "no")
    first = numbered.groupBy("conv_id").agg(F.min("no").alias("first"))
    placed = numbered.join(first, "conv_id").withColumn("i", F.col("no") - F.col("first") + 1)
    return short.select(*columns).unionByName(placed.select(*columns))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, length, depth, da, db, ma, mb, bytes, upto): every rebuilt conversation's prefixes
    from depth 0 (the root) on: digest, the last turn's part of it, its bytes, and all bytes so far."""
    family = F.expr(f"conv_id - conv_id % {FAMILY}")
    taken = F.expr(f"cast(crc32(cast(cast(conv_id as string) as binary)) % {HEADS} as long)")
    heads = (
        turns.where((family == F.col("conv_id")) & (F.col("i") < HEADS))
        .groupBy(F.col("conv_id").alias("family"))
        .agg(F.sort_array(F.collect_list(F.struct("i", "a", "b", "bytes"))).alias("head"))  # HEADS - 1 entries at most
    )
    counted = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", family.alias("family"), taken.alias("h"))
    convs = stored(
        counted.join(heads, "family", "left").select(
            "conv_id", "h", F.expr("coalesce(slice(head, 1, cast(h as int)), cast(array() as array<struct<i: bigint, a: bigint, b: bigint, bytes: bigint>>))").alias("head"), "n"
        ).withColumn("k", F.size("head").cast("long")).withColumn("length", F.expr("k + greatest(n - h, 0L)")),
        "trie-conversations",
    )
    shared = convs.select("conv_id", "length", F.inline("head")).withColumnRenamed("i", "depth")
    shift = convs.select("conv_id", "length", "h", "k")
    own = turns.where(F.col("i") > taken).join(shift, "conv_id").select("conv_id", "length", F.expr("i - h + k").alias("depth"), "a", "b", "bytes")
    piece = F.expr(f"(depth - 1) div {PIECE}").alias("piece")
    parts = shared.unionByName(own).select("conv_id", "length", "depth", piece, _mixed("ma", 3), _mixed("mb", 4), "bytes")
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stored(
        parts.select("*", F.expr("bit_xor(ma)").over(inside).alias("da"), F.expr("bit_xor(mb)").over(inside).alias("db"), F.sum("bytes").over(inside).alias("upto")),
        "trie-pieces",
    )
    # what stands before the later pieces of conversations of more than PIECE turns
    sums = local.groupBy("conv_id", "piece").agg(F.expr("bit_xor(ma)").alias("xa"), F.expr("bit_xor(mb)").alias("xb"), F.sum("bytes").alias("xs"))
    many = local.where("piece > 0").select("conv_id").distinct()
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.join(many, "conv_id", "left_semi").select(
        "conv_id", "piece",
        F.expr("bit_xor(xa)").over(before).alias("xa"), F.expr("bit_xor(xb)").over(before).alias("xb"), F.sum("xs").over(before).alias("xs"),
    ).where("piece > 0")
    zero = F.lit(0).cast("long")
    added = local.join(carry, ["conv_id", "piece"], "left")
    prefixes = added.select(
        "conv_id", "length", "depth",
        F.col("da").bitwiseXOR(F.coalesce("xa", zero)).alias("da"), F.col("db").bitwiseXOR(F.coalesce("xb", zero)).alias("db"),
        "ma", "mb", "bytes", (F.col("upto") + F.coalesce("xs", zero)).alias("upto"),
    )
    roots = convs.select("conv_id", "length", *[zero.alias(c) for c in ("depth", "da", "db", "ma", "mb", "bytes", "upto")])
    return prefixes.unionByName(roots)


def _cells(da, db, cells: int):
    """The cell of every digest in each row: (ROWS, n)."""
    import numpy as np

    a, b = da.view(np.uint64), db.view(np.uint64) | np.uint64(1)
    return np.stack([((a + np.uint64(r) * b) ^ ((a + np.uint64(r) * b) >> np.uint64(29))) % np.uint64(cells) for r in range(ROWS)]).astype(np.int64)


def sketch(prefixes: DataFrame, cells: int):
    """Cells that count two or more, as ``ROWS`` bitmaps."""
    import numpy as np

    def local(batches):
        """Cells of a batch by segment, those met once and those met more often."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            at = _cells(batch.column("da").to_numpy(), batch.column("db").to_numpy(), cells)
            flat, n = np.unique(at + np.arange(ROWS)[:, None] * cells, return_counts=True)
            segment = flat // SEGMENT
            cut = np.flatnonzero(np.diff(segment)) + 1
            inside = (flat % SEGMENT).astype(np.uint16)
            once = [x.tobytes() for x in np.split(inside, cut)]
            more = [x[m > 1].tobytes() for x, m in zip(np.split(inside, cut), np.split(n, cut))]
            yield pa.RecordBatch.from_arrays([pa.array(segment[np.r_[0, cut]]), pa.array(once, pa.binary()), pa.array(more, pa.binary())], names=["segment", "once", "more"])

    def merged(batches):
        import numpy as np
        import pyarrow as pa

        counts: dict = {}
        for batch in batches:
            for segment, once, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
                c = counts.setdefault(segment, np.zeros(SEGMENT, dtype=np.uint8))
                for raw in (once, more):
                    place = np.frombuffer(raw, dtype=np.uint16)
                    c[place] = np.minimum(c[place] + 1, 2)
        for segment, c in counts.items():
            bits = np.packbits(c > 1, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([bits], pa.binary())], names=["segment", "bits"])

    parts = prefixes.select("da", "db").mapInArrow(local, "segment long, once binary, more binary")
    rows = parts.repartition("segment").mapInArrow(merged, "segment long, bits binary").collect()  # ROWS * cells / 8 bytes at most
    out = np.zeros(ROWS * cells // 8, dtype=np.uint8)
    for row in rows:
        at = row["segment"] * SEGMENT // 8
        out[at : at + SEGMENT // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def screened(prefixes: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The prefixes of depth 1 and more with ``maybe`` (may be shared) and ``maybe_before`` (that of the
    prefix one turn shorter)."""
    n = prefixes.count()
    cells = LEAST_CELLS
    while cells < min(8 * n, most_cells):
        cells *= 2
    bits = prefixes.sparkSession.sparkContext.broadcast(sketch(prefixes, cells).tobytes())

    def run(batches):
        import numpy as np
        import pyarrow as pa

        bitmap = np.frombuffer(bits.value, dtype=np.uint8)

        def flagged(da, db):
            out = np.ones(len(da), dtype=bool)
            for r, at in enumerate(_cells(da, db, cells)):
                at = at + r * cells
                out &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            return out

        for batch in batches:
            da, db, ma, mb, depth = (batch.column(c).to_numpy() for c in ("da", "db", "ma", "mb", "depth"))
            own, before = flagged(da, db), flagged(da ^ ma, db ^ mb) | (depth == 1)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own), pa.array(before)], names=[*batch.schema.names, "maybe", "maybe_before"])

    kinds = ", ".join(f"{n} {k}" for n, k in prefixes.dtypes)
    return prefixes.mapInArrow(run, f"{kinds}, maybe boolean, maybe_before boolean")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(da, db, depth, ends_sha256) of the nodes at which conversations end."""
    node = ["da", "db", "depth"]
    lists = ends.groupBy(*node, F.expr(f"(conv_id - pmod(conv_id, {PIECE}L)) div {PIECE}").alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = lists.select(*node, "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    texts = stored(texts, "trie-ends")
    pieces = texts.groupBy(*node).agg(F.count("*").alias("pieces"), F.min("ids").alias("ids"))
    single = pieces.where("pieces = 1").select(*node, F.sha2("ids", 256).alias("ends_sha256"))
    several = texts.join(pieces.where("pieces > 1").select(*node), node, "left_semi")

    def run(batches):
        """Digests of lists that come piece by piece, in order."""
        import hashlib

        import pyarrow as pa

        names, kinds = [*node, "ends_sha256"], (pa.int64(), pa.int64(), pa.int64(), pa.string())
        current, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*node, "ids"])):
                if key != current:
                    if current:
                        done.append((*current, state.hexdigest()))
                    current, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
        if current:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip((*current, state.hexdigest()), kinds)], names=names)

    streamed = several.repartition(*node).sortWithinPartitions(*node, "piece").select(*node, "ids")
    return single.unionByName(streamed.mapInArrow(run, "da long, db long, depth long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    prefixes = stored(rebuilt(stored(ordered_turns(conversations), "trie-ordered")), "trie-prefixes")
    flags = stored(screened(prefixes.where("depth > 0"), most_cells), "trie-screened")
    node, one, zero = ["da", "db", "depth"], F.lit(1).cast("long"), F.lit(0).cast("long")
    empty = F.sha2(F.lit(""), 256)
    tail = flags.where(~F.col("maybe")).select(
        "conv_id", "depth", "maybe_before",
        one.alias("n_convs"), (F.col("depth") < F.col("length")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(empty).alias("ends_sha256"),
    )
    # exact: what may be shared, and the root
    columns = ["conv_id", "length", *node, "bytes", "upto", "maybe_before"]
    shared = flags.where("maybe").select(*columns)
    nodes = stored(
        shared.groupBy(*node).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("length").alias("longest")), "trie-nodes"
    )
    root = prefixes.where("depth = 0")
    top = root.groupBy(*node).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("length").alias("longest"))  # one row
    figures = ["n_convs", "owner", "longest"]
    members = shared.join(nodes, node).select(*columns, *figures).unionByName(
        root.select(*columns[:-1], F.lit(False).alias("maybe_before")).join(F.broadcast(top), node).select(*columns, *figures)
    )
    members = stored(members, "trie-members")
    other = F.col("owner") != F.col("conv_id")
    known = members.groupBy("conv_id").agg(
        F.coalesce(F.max(F.when(other, F.col("depth"))) + 1, zero).alias("first"),  # first owned depth
        F.coalesce(F.max(F.when(other, F.col("upto"))), zero).alias("foreign"),  # bytes before it
        F.max_by(F.when(other, F.col("owner")), F.when(other, F.col("depth"))).alias("above"),  # owner of the node before it
        # its end is a leaf that it owns: not another's, and nobody goes on there
        F.coalesce(F.max(F.when(F.col("depth") == F.col("length"), other | (F.col("longest") > F.col("length")))), F.lit(False)).alias("no_leaf"),
    )
    known = stored(known, "trie-known")
    joined = members.join(known, "conv_id")
    owned = F.col("owner") == F.col("conv_id")
    goes_on = (F.col("length") > F.col("depth")) & (F.col("depth") + 1 >= F.col("first"))
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("above"))
    grouped = joined.groupBy(*node).agg(
        F.max("owner").alias("conv_id"),
        F.max(F.when(owned & (F.col("depth") > 0), F.when(F.col("maybe_before"), parent).otherwise(F.col("conv_id")))).alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.sum(goes_on.cast("long")).alias("n_children"),
        F.sum((~F.col("no_leaf")).cast("long")).alias("n_leaves"),
        F.sum(F.when(other, F.col("foreign") - F.col("upto") + F.col("bytes")).otherwise(zero)).alias("saved_tokens"),
    )
    ends = _end_digests(members.where("depth = length").select(*node, "conv_id"))
    named = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    exact = grouped.join(ends, node, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty)).select(*named)
    inner = tail.where(~F.col("maybe_before")).withColumn("parent_conv_id", F.col("conv_id")).select(*named)
    # the first node of a tail hangs below a node that may be shared
    edge = tail.where("maybe_before").join(known.select("conv_id", "first", "above"), "conv_id").withColumn("parent_conv_id", parent).select(*named)
    return exact.unionByName(inner).unionByName(edge)
