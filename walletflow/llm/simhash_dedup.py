"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints within three
bits differ in three bytes at most, so they share at least five positional
bytes: the guaranteed minimum.  The index posts every distinct fingerprint
under its positional bytes.  Lists of single bytes hold a 256th of the data
each, so they are read intersected three at a time: of any five positions,
three lie in the same half, and the eight triples inside the halves find every
pair.  Pairs met in a list are tallied over all eight positions, those with
fewer than five shared bytes are dropped, the rest are verified by their bits.

Only links that join components inside a list leave the task, never all
pairs: at most one per member.  Lists over ``LIST`` members are cut into blocks
and every pair of blocks is compared in a task of its own.  Equal fingerprints
are one entry, so exact copies cost nothing.

Components: the smaller label is passed along links, and labels are followed
to their own label, until nothing changes; each round is written to the shared
folder.

Defined results: a null text has no words; texts without words have
fingerprint zero and link like others; a null ``doc_id`` is a row of its group
but never its smallest id (null if the group has no other); repeated rows are
kept; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletflow.llm.common import ship, slices, stored

ship(__name__)
ship("walletflow.llm.common")

SHINGLE = 3  # fixed: words in a shingle
BITS = 3  # fixed: most differing bits
SEED = 42  # fixed: seed of the shingles' XXH64
SHARED = 8 - BITS  # positional bytes that a pair shares at least
TRIPLES = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3), (4, 5, 6), (4, 5, 7), (4, 6, 7), (5, 6, 7))
LIST = 4096  # members of a list that one block holds
TEXT_BYTES = 4 << 20
ROWS = 1 << 17  # index rows compared at once


def fingerprints_of(texts: list, size: int = SHINGLE, seed: int = SEED):
    """One unsigned 64-bit fingerprint per text."""
    import re

    import numpy as np
    import xxhash

    words = re.compile(r"[^\x20\x09-\x0D]+")  # fixed
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    digest = xxhash.xxh64_digest
    out = np.zeros(len(texts), dtype=np.uint64)
    weight = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    for i, text in enumerate(texts):
        w = words.findall((text or "").translate(lower))
        if not w:
            continue
        shingles = map(" ".join, zip(*[w[k:] for k in range(size)])) if len(w) >= size else [" ".join(w)]
        h = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=np.uint8).reshape(-1, 8)
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(h), 1 << 16):  # bounds the bits of very long texts
            ones += np.unpackbits(h[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
        out[i] = weight[2 * ones > len(h)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for piece in slices(batches, TEXT_BYTES, "text"):
            fp = fingerprints_of(piece.column("text").to_pylist(), size)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def _byte(fp: str, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * (7 - position)).bitwiseAND(F.lit(255).cast("long"))


def postings(values: DataFrame) -> DataFrame:
    """(list, fp): every distinct fingerprint under its eight triples of positional bytes."""
    lists = []
    for n, (a, b, c) in enumerate(TRIPLES):
        lists.append(F.shiftleft(F.lit(n).cast("long"), 24) + F.shiftleft(_byte("fp", a), 16) + F.shiftleft(_byte("fp", b), 8) + _byte("fp", c))
    return values.select("fp", F.explode(F.array(*lists)).alias("list"))


def close_pairs(left, right, bits: int = BITS):
    """Masks of pairs: enough shared positional bytes, then few enough differing bits."""
    import numpy as np

    differ = left ^ right
    shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    near = shared >= SHARED
    near[near] = np.bitwise_count(differ[near]) <= bits
    return near


def _forest(pairs, members):
    """Links (smallest of its part, member) of the parts that index pairs join."""
    import numpy as np

    parent = np.arange(len(members))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    top = np.array([root(i) for i in range(len(members))], dtype=np.int64)
    moved = np.flatnonzero(top != np.arange(len(members)))
    return members[top[moved]], members[moved]


def _long_list(fp, side):
    """Links of one long list: a row is compared only with rows outside its part so far."""
    import numpy as np

    part = np.arange(len(fp))
    for i in range(len(fp) - 1):
        rest = np.flatnonzero(part != part[i])
        if side[i]:
            rest = rest[side[rest] != side[i]]
        near = rest[close_pairs(np.full(len(rest), fp[i]), fp[rest])]
        if len(near):
            joined = np.unique(np.append(part[near], part[i]))
            part[np.isin(part, joined)] = joined[0]
    moved = np.flatnonzero(part != np.arange(len(fp)))
    return fp[part[moved]], fp[moved]


def _list_links(fp, key, side):
    """Links inside the lists of sorted rows (key, fp).  ``side`` marks rows of cut lists
    (0: not cut): only pairs of different sides are compared there."""
    import numpy as np

    n = len(fp)
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, n])
    few = size <= 64
    group = np.repeat(np.arange(len(start)), size)

    def short():
        at, step = np.flatnonzero(few[group]), 1
        while len(at):  # all short lists together: every row with the row ``step`` further on
            at = at[at + step < n]
            at = at[group[at] == group[at + step]]
            far = at[(side[at] == 0) | (side[at] != side[at + step])]
            near = far[close_pairs(fp[far], fp[far + step])]
            yield near, near + step
            step += 1

    found = [_forest(short(), fp)]
    for g in np.flatnonzero(~few):
        own = slice(start[g], start[g] + size[g])
        found.append(_long_list(fp[own], side[own]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def link_rows(batches):
    """Arrow batches sorted by (task key, fp) -> links.  A list that goes on in the next batch
    waits for it; lists are bounded by two blocks."""
    import numpy as np
    import pyarrow as pa

    def out(fp, key, side):
        a, b = _list_links(fp, key, side)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS:
            continue
        t = pa.Table.from_batches(held)
        fp, key, side = (t.column(c).to_numpy() for c in ("fp", "part", "side"))
        last = int(np.searchsorted(key, key[-1]))
        if last:
            yield out(fp[:last].view(np.uint64), key[:last], side[:last])
        held, rows = t.slice(last).to_batches(), len(fp) - last
    if rows:
        t = pa.Table.from_batches(held)
        fp, key, side = (t.column(c).to_numpy() for c in ("fp", "part", "side"))
        yield out(fp.view(np.uint64), key, side)


def links(values: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all pairs within the bit distance."""
    index = postings(values)
    sizes = index.groupBy("list").agg(F.count("*").alias("n"))
    long_lists = sizes.where(F.col("n") > LIST).select("list", F.ceil(F.col("n") / LIST).cast("int").alias("blocks"))
    plain = index.join(long_lists, "list", "left_anti").select(
        F.col("list").alias("part"), "fp", F.lit(0).alias("side")
    )
    # a cut list: block b meets every other block and itself, each pair of blocks apart
    cut = index.join(long_lists, "list").select("list", "fp", "blocks", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("b"))
    met = cut.select("list", "fp", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    low, high = F.least("b", "o"), F.greatest("b", "o")
    blocks = met.select(
        F.xxhash64("list", low, high).alias("part"), "fp",
        F.when(F.col("b") == F.col("o"), 0).when(F.col("b") < F.col("o"), 1).otherwise(2).alias("side"),
    )
    parts = plain.unionByName(blocks)
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.repartition(n, "part").sortWithinPartitions("part", "fp")
    return rows.mapInArrow(link_rows, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): smallest linked fingerprint (as a signed number) for every linked fp."""
    both = stored(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "simhash-links")
    label = stored(both.groupBy(F.col("a").alias("fp")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "simhash-labels")
    while True:
        seen = both.join(label, both.b == label.fp).select(F.col("a").alias("fp"), "root")
        lower = label.unionByName(seen).groupBy("fp").agg(F.min("root").alias("root"))
        parent = label.select(F.col("fp").alias("at"), F.col("root").alias("above"))
        jumped = lower.join(parent, F.col("root") == F.col("at"), "left").select(
            "fp", F.least("root", F.coalesce("above", "root")).alias("root")
        )
        fresh = stored(jumped, "simhash-labels")
        moved = fresh.join(label.withColumnRenamed("root", "old"), "fp").where("root <> old").limit(1).count()
        label = fresh
        if not moved:
            return label


def near_duplicates(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, root, component_id): one row per document.  ``root`` names the component;
    ``component_id`` is its smallest ``doc_id``."""
    prints = stored(fingerprints(docs, text, size), "simhash-prints")
    values = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = components(links(values.select("fp")))
    named = values.join(root, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", "root", "component_id")


def simhash_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
