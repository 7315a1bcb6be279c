"""Document scores from a gated recurrent language model and from word counts.

Counting: every training document's words are counted by Spark (partial
aggregates first); the count table is stored and grows with the corpus.

Model (``gated_model``): the most frequent words are numbered; any other word is
"outside", and its probability is the model's for "outside" times its smoothed
share of all outside counts, so the score is a probability of the whole text.
Training: every token of every training document is learned.  A text is stored as
rows of ``ROW`` tokens; texts of similar length form lots, and a task learns a
lot's first rows, then its second rows and so on, each from the state after the
row before, so no task holds more than ``BATCH`` rows.  ``ROUNDS`` parts of the
documents are learned one after another, each by tasks that start from the same
parameters and whose changes are averaged (weighted by tokens) block by block,
a block being the parameters of a run of words, so the driver gets one parameter set
whatever the number of tasks.  Rows are sorted inside a task, so a repeated task
learns the same.

Scoring: one pass over all whole texts.  The tables sent to the tasks have a
fixed size (``FREQUENT`` words and one parameter set).  Words outside the
frequent table leave the pass as rows and are joined with the count table, so
no word is left out of either score.

Defined results: a null text is empty and has one token, the end; a null
``doc_id`` counts as held out (its text is the empty string); repeated rows are
counted and scored each; with no training document at all every count is 0;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletflow.llm import gated_model
from walletflow.llm.common import ship, slices, stored

ship(__name__)
ship("walletflow.llm.common")
ship("walletflow.llm.gated_model")

FREQUENT = gated_model.WORDS - 2  # words in the table sent to every task: all that the model numbers
ROW = 1024  # tokens of a training text in one row: whole windows
BATCH = 1024  # texts learned together
TASK_TOKENS = 4_000_000  # tokens from which a round uses a further task
ROUNDS = 2
TASKS = 1024  # most training tasks in a round
TEXT_BYTES = 4 << 20  # text tokenised at once
SCORE_TOKENS = 2_000_000  # tokens scored together
END = ""  # no word is empty
HELD = 500_000  # words whose counts a task holds


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def words_of(text: str | None) -> list[bytes]:
    """The words in UTF-8: bytes.split parts at the same six characters as ``WORD``, and bytes.lower
    changes A-Z only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over rows of ``text``; every row also counts one end.  Counts are added up in the
    tasks, ``HELD`` words at a time, before they are shuffled."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        held: Counter = Counter()

        def flush():
            rows = list(held.items())
            held.clear()
            for at in range(0, len(rows), 50_000):
                words, n = zip(*rows[at : at + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["token", "c"])

        for piece in slices(batches, TEXT_BYTES, "text"):
            for text in piece.column("text").to_pylist():
                held.update(words_of(text))
            held[b""] += piece.num_rows
            if len(held) > HELD:
                yield from flush()
        if held:
            yield from flush()

    words = texts.select("text").mapInArrow(run, "token binary, c long")
    return stored(words.groupBy(F.col("token").cast("string").alias("token")).agg(F.sum("c").alias("c")), "word-counts")


def _tokens_of(table: dict):
    """texts -> (numbers of all tokens, words outside the table).  ``table`` is by UTF-8."""
    from itertools import repeat

    import numpy as np

    number = table.get

    def tokens(text):
        words = words_of(text)
        ids = np.fromiter(map(number, words, repeat(-1)), dtype=np.int32, count=len(words))
        return np.append(ids, 0), [words[i].decode("utf-8", "replace") for i in np.flatnonzero(ids < 0)]

    return tokens


def _token_rows(docs: DataFrame, table, words: int) -> DataFrame:
    """(part, kind, h, at, k, more, ids): all model numbers of every document in rows of ``ROW``.
    ``kind`` is the text's length class, ``k`` counts its rows; ``h`` and ``at`` tell texts apart."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tokens = _tokens_of(table.value[0])
        for piece in slices(batches, TEXT_BYTES, "text"):
            out = []
            for text, h, at in zip(*[piece.column(c).to_pylist() for c in ("text", "h", "at")]):
                ids, _ = tokens(text)
                ids = np.where((ids < 0) | (ids >= words), 1, ids).astype("<u2")
                for k in range(0, len(ids), ROW):
                    out.append((len(ids).bit_length(), h, at, k // ROW, k + ROW < len(ids), ids[k:k + ROW].tobytes()))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["kind", "h", "at", "k", "more", "ids"])

    keyed = docs.select("text", F.xxhash64("doc_id", "text").alias("h"), F.monotonically_increasing_id().alias("at"))
    rows = keyed.mapInArrow(run, "kind int, h long, at long, k long, more boolean, ids binary")
    return rows.withColumn("part", F.pmod(F.shiftright("h", 8), F.lit(ROUNDS)).cast("int"))


def _lots(rows: DataFrame) -> DataFrame:
    """Add ``lot``: about ``BATCH`` texts of one part and length class."""
    sizes = rows.where("k = 0").groupBy("part", "kind").agg(F.count("*").alias("n")).collect()  # a row per class: fixed size
    lots = F.lit(1)
    for r in sizes:
        lots = F.when((F.col("part") == r["part"]) & (F.col("kind") == r["kind"]), F.lit(-(-r["n"] // BATCH))).otherwise(lots)
    return rows.withColumn("lot", F.xxhash64("kind", F.pmod(F.xxhash64("h"), lots)))


def _learn(lots: DataFrame, part: int, params, tasks: int):
    """Average of what the tasks learn from one part of the texts."""
    import numpy as np

    start = lots.sparkSession.sparkContext.broadcast(gated_model.pack(params).astype(np.float32))

    def blocks_batch(blocks):
        import pyarrow as pa

        kinds = (("block", pa.int32()), ("tokens", pa.int64()), ("sums", pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*blocks), kinds)], names=[n for n, _ in kinds])

    def learn(batches):
        import numpy as np

        tokens = 0

        def rows():
            nonlocal tokens
            for batch in batches:
                for lot, k, at, more, ids in zip(*[batch.column(c).to_pylist() for c in ("lot", "k", "at", "more", "ids")]):
                    tokens += len(ids) // 2
                    yield (lot, k), at, more, np.frombuffer(ids, dtype="<u2").astype(np.int64)

        begin = gated_model.unpack(start.value)
        learned = gated_model.train_rows(begin, rows(), BATCH)
        if tokens:
            for n in gated_model.NAMES:
                learned[n] -= begin[n]
            for c, values in gated_model.blocks(learned):
                yield blocks_batch([(c, tokens, values.astype("<f4").tobytes())])

    def add(batches):
        import numpy as np

        block, total, tokens = None, None, 0
        for batch in batches:
            for b, n, sums in zip(batch.column("block").to_pylist(), batch.column("tokens").to_pylist(), batch.column("sums")):
                values = np.frombuffer(sums.as_buffer(), dtype="<f4").astype(np.float64) * n
                if b != block:
                    if total is not None:
                        yield blocks_batch([(block, tokens, total.tobytes())])
                    block, total, tokens = b, values, n
                else:
                    total += values
                    tokens += n
        if total is not None:
            yield blocks_batch([(block, tokens, total.tobytes())])

    rows = lots.where(F.col("part") == part).select("lot", "k", "h", "at", "more", "ids")
    rows = rows.repartitionById(tasks, F.pmod("lot", F.lit(tasks)).cast("int")).sortWithinPartitions("lot", "k", "h", "at")
    schema = "block int, tokens long, sums binary"
    partitions = int(lots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    changes = rows.mapInArrow(learn, schema).repartition(min(gated_model.BLOCKS, partitions), "block")
    for r in changes.sortWithinPartitions("block", "tokens", "sums").mapInArrow(add, schema).toLocalIterator():
        gated_model.add_block(params, r["block"], np.frombuffer(r["sums"], dtype="<f8") / r["tokens"])
    return params


def _scored(docs: DataFrame, table, words: int, params) -> DataFrame:
    """(doc_id, n_tokens, base, score, rare): sums over the frequent tokens, and the other words, each once
    with its number of times."""
    import numpy as np

    start = docs.sparkSession.sparkContext.broadcast(gated_model.pack(params).astype(np.float32))

    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        table_of, base_of, outside_of = table.value
        tokens = _tokens_of(table_of)
        model = gated_model.Model(gated_model.unpack(start.value))

        def flush(doc_ids, texts, rare):
            length = np.array([len(t) for t in texts])
            owner = np.repeat(np.arange(len(texts)), length)
            flat = np.concatenate(texts)
            known, who = flat[flat >= 0], owner[flat >= 0]
            base = np.bincount(who, weights=base_of[known], minlength=len(texts))
            tail = np.bincount(who, weights=outside_of[known], minlength=len(texts))
            numbers = [np.where((t < 0) | (t >= words), 1, t) for t in texts]
            score = model.score(numbers) / np.log(10) + tail
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(doc_ids), pa.array(length, pa.int64()), pa.array(base), pa.array(score), pa.array(rare, pa.map_(pa.string(), pa.int64()))],
                names=["doc_id", "n_tokens", "base", "score", "rare"],
            )

        ids, texts, rare, held = [], [], [], 0
        for piece in slices(batches, TEXT_BYTES, "text"):
            ids.append(piece.column("doc_id"))
            for text in piece.column("text").to_pylist():
                t, r = tokens(text)
                texts.append(t)
                rare.append(list(Counter(r).items()))
                held += len(t)
            if held >= SCORE_TOKENS:
                yield flush(ids, texts, rare)
                ids, texts, rare, held = [], [], [], 0
        if texts:
            yield flush(ids, texts, rare)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, base double, score double, rare map<string,bigint>")


def score_documents(docs: DataFrame, smoothing: float = 0.1) -> DataFrame:
    """One row per document: counts, word-count score and model score (log10)."""
    import numpy as np

    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    train = texts.where(~held_out(F.col("doc_id")))
    counts = word_counts(train)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # a table of fixed size: the most frequent words in order, ties by word
    top = counts.where(F.col("token") != END).orderBy(F.desc("c"), "token").limit(FREQUENT).collect()
    ends = sum(r["c"] for r in counts.where(F.col("token") == END).collect())
    words = min(gated_model.WORDS, len(top) + 2)  # numbers of the model: 0 end, 1 outside, then words
    size = np.array([ends, 0, *[r["c"] for r in top]], dtype=np.float64)
    inside = int(size[:words].sum())
    outside_n, outside_v = n - inside, max(0, v - (words - 2) - (1 if ends else 0))
    base = np.log10((size + smoothing) / (n + smoothing * (v + 1)))
    tail_sum = outside_n + smoothing * (outside_v + 1)
    tail = np.where(np.arange(len(size)) < words, 0.0, np.log10((size + smoothing) / tail_sum))
    table = spark.sparkContext.broadcast(({r["token"].encode(): i + 2 for i, r in enumerate(top)}, base, tail))

    share = size[:words].copy()
    share[1] = outside_n
    params = gated_model.initial(share)
    tasks = min(TASKS, -(-n // (ROUNDS * TASK_TOKENS)) or 1)  # by the corpus alone: scores do not depend on the session
    lots = _lots(stored(_token_rows(train, table, words), "token-rows"))
    for part in range(ROUNDS):
        params = _learn(lots, part, params, tasks)

    at = F.monotonically_increasing_id()
    scored = stored(_scored(texts, table, words, params).withColumn("at", at), "scored-texts")
    rare = scored.select("at", F.explode("rare").alias("token", "times"))
    joined = rare.join(counts, "token", "left").select("at", "times", F.coalesce("c", F.lit(0)).alias("c"))
    own = F.col("c") + F.lit(smoothing)
    late = joined.groupBy("at").agg(
        F.sum(F.when(F.col("c") == 0, F.col("times")).otherwise(0)).alias("unknown"),
        F.sum(F.col("times") * F.log10(own / F.lit(float(n + smoothing * (v + 1))))).alias("late_base"),
        F.sum(F.col("times") * F.log10(own / F.lit(float(tail_sum)))).alias("late_score"),
    )
    zero = F.lit(0)
    ends_known = F.lit(0 if ends else 1)  # without training documents the end is unknown too
    return scored.drop("rare").join(late, "at", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_tokens") - F.coalesce("unknown", zero) - ends_known).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("late_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("late_score", F.lit(0.0))).alias("score"),
    )
