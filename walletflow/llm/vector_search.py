"""Exact top-k by inner product: columnar branch and bound.

Candidate vectors of a task stand in vertical layout, one row per dimension.
A query adds up its products dimension block by dimension block, its heaviest
blocks first.  What a candidate can still gain or lose is bounded by the
remaining masses (Cauchy-Schwarz on the dimensions not yet seen), so a
candidate whose best case is below the k-th worst case is dropped and the
arrays are compacted.  Sums are whole numbers and exact; bounds carry slack for
rounding; ties at the threshold stay.

Queries come to the tasks in blocks of ``QUERY_BLOCK`` (a fixed broadcast
size): the driver holds one block at a time.  Every block is one pass over the
candidates that leaves k rows per query and task; passes are written to the
shared folder and merged per query at the end.

Defined results: null vectors, and vectors with null or non-finite components,
take no part; vectors only meet vectors of their own length; a null ``vec_id``
is a candidate that comes last among ties, never a query; rows with a query's
``vec_id`` are its own; repeated candidates each take a place, repeated
queries are one; components beyond 2^25 in size are summed as Python integers
and clipped to 64 bits; extra columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletflow.llm.common import ship
from walletflow.session import scratch_path

ship(__name__)

SCALE = 1024  # fixed
EVERY = 100  # fixed: ids divisible by this are queries
TOP = 10  # fixed
DIMENSIONS = 8  # dimensions in a block
QUERY_BLOCK = 4096
CHUNK = 16384  # candidates in one vertical block
EXACT = 1 << 25  # components up to this size: products and sums stay below 2^53 for 8 dimensions


def _search_chunk(x, ids, nulls, queries, top):
    """Improve ``top`` (query number -> sorted rows (-score, null id, id)) with the columns of x."""
    import numpy as np

    dims, n = x.shape
    blocks = [slice(a, min(a + DIMENSIONS, dims)) for a in range(0, dims, DIMENSIONS)]
    exact = n and float(np.abs(x).max(initial=0)) ** 2 * max(dims, 1) < 2.0**52
    mass = np.array([(x[b].astype(np.float64) ** 2).sum(axis=0) for b in blocks]).reshape(len(blocks), n)
    all_mass = mass.sum(axis=0)
    for number, qid, q, k in queries:
        best = top[number]
        alive = np.flatnonzero(nulls | (ids != qid))
        if not exact or float(np.abs(q).max(initial=0)) ** 2 * max(dims, 1) >= 2.0**52:
            whole = [int(v) for v in q]
            score = [sum(a * int(b) for a, b in zip(whole, x[:, i])) for i in alive]
            score = np.array([min(max(s, -(2**63)), 2**63 - 1) for s in score], dtype=np.int64)
        else:
            weight = np.array([(q[b] ** 2).sum() for b in blocks])
            left_q, left_x = weight.sum(), all_mass[alive]
            partial = np.zeros(len(alive))
            worst_kept = -best[k - 1][0] if len(best) >= k else -np.inf
            for b in np.argsort(-weight, kind="stable"):
                partial = partial + q[blocks[b]] @ x[blocks[b]][:, alive] if len(alive) < n else partial + (q[blocks[b]] @ x[blocks[b]])[alive]
                left_q, left_x = max(left_q - weight[b], 0.0), np.maximum(left_x - mass[b][alive], 0.0)
                bound = np.sqrt(left_q * left_x) * (1 + 1e-9) + 0.25
                least = partial - bound
                limit = worst_kept
                if len(least) >= k:
                    limit = max(limit, np.partition(least, len(least) - k)[len(least) - k])
                stay = partial + bound >= limit
                if not stay.all():
                    alive, partial, left_x = alive[stay], partial[stay], left_x[stay]
            score = np.rint(partial).astype(np.int64)
        rows = best + [(-int(s), bool(nulls[i]), int(ids[i])) for s, i in zip(score, alive)]
        rows.sort()
        top[number] = rows[:k]


def _partial_top(queries, k):
    """Candidates of a task -> its k best rows per query."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        own = {}
        for number, qid, q in queries.value:
            own.setdefault(len(q), []).append((number, qid, np.array(q, dtype=np.float64), k))
        top = {number: [] for number, _, _ in queries.value}
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(at, CHUNK)
                vectors = piece.column("v")
                length = np.diff(vectors.offsets.to_numpy())
                flat = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py():vectors.offsets[-1].as_py()]
                first = np.cumsum(length) - length
                null = piece.column("vec_id").is_null().to_numpy(zero_copy_only=False)
                ids = piece.column("vec_id").fill_null(0).to_numpy()
                for dims in np.unique(length):
                    if int(dims) in own:
                        rows = np.flatnonzero(length == dims)
                        x = np.ascontiguousarray(flat[first[rows][:, None] + np.arange(dims)].T) if dims else np.zeros((0, len(rows)))
                        _search_chunk(x, ids[rows], null[rows], own[int(dims)], top)
        found = [(n, None if null else i, -s) for n, rows in top.items() for s, null, i in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[j] for f in found], pa.int64()) for j in range(3)], names=["number", "vec_id", "score"]
        )

    return run


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): scaled and floored components; incomplete vectors are left out."""
    x = F.transform(column, lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), good.alias("good")).where(
        F.col("x").isNotNull() & F.col("good")
    ).select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("double")).alias("v"))


def exact_top(vectors: DataFrame, k: int = TOP, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query against all candidates."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors)
    path = scratch_path(spark, "top-k")
    schema = "number long, vec_id long, score long, query_id long"
    spark.createDataFrame([], schema).write.parquet(path)  # no query, no pass
    block, number = [], 0

    def search():
        queries = spark.sparkContext.broadcast([(n, i, v) for n, i, v in block])
        found = whole.mapInArrow(_partial_top(queries, k), "number long, vec_id long, score long")
        names = F.broadcast(spark.createDataFrame([(n, i) for n, i, _ in block], "number long, query_id long"))
        found.join(names, "number").select("number", "vec_id", "score", "query_id").write.mode("append").parquet(path)
        queries.destroy()

    for row in whole.where(F.col("vec_id") % every == 0).distinct().toLocalIterator():
        block.append((number, row["vec_id"], row["v"]))
        number += 1
        if len(block) == QUERY_BLOCK:
            search()
            block = []
    if block:
        search()
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    merged = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(order))
    return merged.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
