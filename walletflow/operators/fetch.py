"""Keyed fetch in retry rounds (the only Python on the data path).

A user-supplied fetch function is called once per pending key inside
``mapInPandas``; each partition runs a small thread pool (the service is
I/O bound), so the total request rate is about
``partitions x threads / request_delay``; cap ``max_partitions`` to respect
the service's limit.  A task has at most ``keys_per_partition`` keys; where that makes
fewer tasks than the cluster can run, there are more of them (``_tasks``).  With ``calls_per_sec`` the rate holds for the whole run,
whatever the number of tasks: every wave leases an equal part of the current rate
to each of its tasks, which spaces its calls by it.  After a wave the share of 429
among its landed attempts decides: over ``throttled_share`` the rate is multiplied
by ``slow_down``, else by ``speed_up`` up to the limit.  The decisions are landed
(``<landing>/_rates``), so a resumed run goes on at the rate it had reached.

Rounds: every round lands its attempts (one row per pending key) in a
shared landing folder, ``<landing>/round=<r>``, with the success flag
already decided by the JVM-side document rules (a 200 whose body fails to
parse is a failure, as in the reference).  The next round's pending set is
read back from the landed failures, so

* a key is never fetched twice in one round even if a stage is recomputed
  (the fetch output is read from files, never re-derived);
* a lost executor only re-runs its own task, whose partial output the
  commit protocol discards (at-least-once calls, exactly-once landed rows);
* there is no anti-join shuffle between rounds.

Contexts of ``IN_PLACE_BYTES`` and more a key (documents) do not travel with the failures: they would be
written and shuffled once more in every round.  They are staged once, in files of at most a task's keys
(``_pending/round=1/waves``, marked by ``_pending/_in_place``).  Every round reads those files where they lie, a
task per file, and keeps the keys that failed in the round before (a broadcast of at most ``IN_PLACE_KEYS``
addresses a job).  All rounds then have the waves of the first one.

Fetch function contract: ``fetch(req: FetchRequest) -> (status, body)``;
it may raise ``TimeoutError`` / ``ConnectionError`` / any exception, which
become failed attempts with status ``timeout`` / ``connection_error`` /
``error``.  Every failure is retried alike by default (parity); statuses in
``no_retry`` stop at their first occurrence.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass, field
from functools import partial
from typing import Any, Callable, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletflow.schemas import (
    DEFAULT_BACKOFF_429,
    DEFAULT_MAX_ROUNDS,
    DEFAULT_REQUEST_DELAY,
    DEFAULT_ROUND_DELAY,
    DEFAULT_THREADS,
    DEFAULT_TIMEOUT,
    LABEL_NO_DATA,
    LOOSE_MAP_DDL,
    PORTFOLIO_NO_DATA,
)
from walletflow.session import COMPACT, one_file_a_task, release_shuffles, scratch_path
from walletflow.sinks import folders
from walletflow.sinks.csv import path_size
from walletflow.shipping import ship_package


class FetchRequest(NamedTuple):
    address: str | None
    attempt: int
    as_of_ms: int | None
    context: str | None
    timeout: float = DEFAULT_TIMEOUT   # per-call timeout a fetch function should apply


ATTEMPT_SCHEMA = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("http_ok", T.BooleanType()),
    T.StructField("body", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("elapsed_ms", T.LongType()),
])


# Landed attempt rows: the attempt plus the decided outcome and the
# round / wave partition columns.
LANDED_SCHEMA = T.StructType(
    list(ATTEMPT_SCHEMA.fields)
    + [
        T.StructField("ok", T.BooleanType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("wave", T.IntegerType()),
    ]
)


# Staged keys, read back without a job that infers the schema.
KEY_SCHEMA = "address string, context string"
LANDED_ROUND_SCHEMA = T.StructType([f for f in LANDED_SCHEMA.fields if f.name != "round"])
LANDED_WAVE_SCHEMA = T.StructType([f for f in LANDED_ROUND_SCHEMA.fields if f.name != "wave"])

BUSY_KEYS = 2000        # keys for which a further task is worth its start
STAGED_KEYS = 16_384    # keys per file of a staged wave, so that no task reads a whole wave
STAGED_BYTES = 8 << 20  # and bytes, as large contexts make few keys long work
IN_PLACE_BYTES = 1024   # contexts of so many bytes a key, on average, stay where they are staged
IN_PLACE_KEYS = 1 << 18  # failed keys that a job over such contexts holds in memory at most
WAVE_SECONDS = 10.0     # waves are fetched several in one job as long as the job ends within about this time
BATCH_ROWS = 2000       # a worker hands on its attempts when it holds so many
BATCH_CHARS = 4 << 20   # or so many characters of bodies


@dataclass
class FetchOptions:
    kind: str = "labels"                    # 'labels' | 'portfolio'
    threads: int = DEFAULT_THREADS
    request_delay: float = DEFAULT_REQUEST_DELAY
    backoff_429: float = DEFAULT_BACKOFF_429
    round_delay: float = DEFAULT_ROUND_DELAY
    max_rounds: int = DEFAULT_MAX_ROUNDS
    timeout: float = DEFAULT_TIMEOUT
    max_partitions: int = 64                # bounds concurrent calls
    keys_per_partition: int = 2000
    as_of_ms: int | None = None             # portfolio as-of, one value per batch
    no_retry: frozenset = field(default_factory=frozenset)
    calls_per_sec: float | None = None      # most calls a second of the whole run, instead of request_delay
    slow_down: float = 0.5
    speed_up: float = 1.1
    throttled_share: float = 0.01

    @property
    def no_data_message(self) -> str:
        return LABEL_NO_DATA if self.kind == "labels" else PORTFOLIO_NO_DATA


class Pacer:
    """Calls of one task's threads, at least ``gap`` seconds apart."""

    def __init__(self, gap: float):
        import threading

        self.gap, self.lock, self.free_at = gap, threading.Lock(), 0.0

    def __call__(self) -> None:
        with self.lock:
            at = max(self.free_at, time.monotonic())
            self.free_at = at + self.gap
        pause = at - time.monotonic()
        if pause > 0:
            time.sleep(pause)


def classify_call(fetch: Callable[[FetchRequest], Any], req: FetchRequest, opts: FetchOptions, wait=None) -> tuple:
    """One call -> (status, http_ok, body, detail, elapsed_ms). Never raises."""
    if wait is not None:
        wait()
    elif opts.request_delay:
        time.sleep(opts.request_delay)
    t0 = time.monotonic()
    try:
        status, body = fetch(req)
        status = int(status)
        if status == 200:
            out = ("200", True, body, None)
        else:
            if status == 429 and opts.backoff_429:
                time.sleep(opts.backoff_429)
            out = (str(status), False, None, f"HTTP {status}")
    except TimeoutError as exc:
        out = ("timeout", False, None, str(exc) or "timeout")
    except ConnectionError as exc:
        out = ("connection_error", False, None, str(exc) or "connection failed")
    except Exception as exc:  # noqa: BLE001 - every failure is data
        out = ("error", False, None, f"{type(exc).__name__}: {exc}")
    return (*out, int((time.monotonic() - t0) * 1000))


def _drawn_calls(pool, threads: int, reqs: list, call) -> list:
    """Results of the first requests, in order: every thread draws the next one until all are done or
    the bodies held exceed ``BATCH_CHARS``."""
    import threading

    lock, turn, results, held = threading.Lock(), iter(range(len(reqs))), {}, 0

    def draw() -> None:
        nonlocal held
        while True:
            with lock:
                i = next(turn, None) if held < BATCH_CHARS else None
            if i is None:
                return
            got = call(reqs[i])
            with lock:
                results[i] = got
                held += len(got[2]) if isinstance(got[2], str) else 0

    for drawn in [pool.submit(draw) for _ in range(min(threads, len(reqs)))]:
        drawn.result()
    return [results[i] for i in range(len(results))]


def _fetch_partitions(fetch, attempt: int, opts: FetchOptions, gap: float | None = None, keep: tuple = (), echo: bool = True):
    """mapInPandas body: a thread pool per partition, one row per key with the columns ``keep``, and its
    context if ``echo``; calls ``gap`` seconds apart."""

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd

        wait, threads = None if gap is None else Pacer(gap), max(1, opts.threads)
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for pdf in batches:
                addrs = pdf["address"].tolist()
                ctx = pdf["context"].tolist()
                reqs = [
                    FetchRequest(None if a is None else str(a), attempt, opts.as_of_ms, c, opts.timeout)
                    for a, c in zip(addrs, ctx)
                ]
                at = 0
                while at < len(reqs):
                    results = _drawn_calls(pool, threads, reqs[at : at + BATCH_ROWS], lambda r: classify_call(fetch, r, opts, wait))
                    some = slice(at, at + len(results))
                    at += len(results)
                    yield pd.DataFrame({
                        "address": addrs[some],
                        "context": ctx[some] if echo else [None] * len(results),
                        "attempt": [attempt] * len(results),
                        "status": [r[0] for r in results],
                        "http_ok": [r[1] for r in results],
                        "body": [r[2] for r in results],
                        "detail": [r[3] for r in results],
                        "elapsed_ms": [r[4] for r in results],
                        **{c: pdf[c].iloc[some].tolist() for c in keep},
                    })

    return run


def _tasks(spark: SparkSession, n_keys: int, opts: FetchOptions) -> int:
    """Tasks of a wave: at most ``keys_per_partition`` keys in each and, where that leaves cores idle, one
    per ``BUSY_KEYS`` keys up to the cluster's cores; never more than ``max_partitions``."""
    needed = math.ceil(n_keys / max(1, opts.keys_per_partition))
    busy = min(spark.sparkContext.defaultParallelism, math.ceil(n_keys / BUSY_KEYS))
    return max(1, min(opts.max_partitions, max(needed, busy)))


def fetch_once(pending: DataFrame, fetch, attempt: int, opts: FetchOptions, partitions: int,
               spread: bool = True, rate: float | None = None, echo: bool = True) -> DataFrame:
    """K1/K2/K3: one concurrent round over ``pending`` (address, context).

    ``spread`` round-robins the keys over ``partitions`` tasks; later rounds
    read landed failures that are already spread and only narrow them.  ``rate``: calls a second of
    all tasks together.  Without ``echo`` the attempts hold no context."""
    ship_package(pending.sparkSession)
    src = pending.select(F.col("address").cast("string"), F.col("context").cast("string"))
    src = src.repartition(partitions) if spread else src.coalesce(partitions)
    gap = None if rate is None else partitions / rate
    return src.mapInPandas(_fetch_partitions(fetch, attempt, opts, gap, echo=echo), ATTEMPT_SCHEMA)


def _dealt(waves: DataFrame, first: int, n: int, parts: int) -> DataFrame:
    """The keys of ``n`` waves from ``first`` on over at most ``parts`` tasks: a wave's keys go to one task, or to
    as many as leave none idle, so a landed wave has few files."""
    subs = max(1, parts // n)
    slot = (F.col("wave") - F.lit(first)) * subs + F.pmod(F.hash("address"), F.lit(subs))
    tasks = min(parts, n * subs)
    return waves.repartitionById(tasks, F.pmod(slot, F.lit(tasks)).cast("int"))


def with_success(attempts: DataFrame, opts: FetchOptions, valid: Column | None = None) -> DataFrame:
    """success = HTTP 200 and a document the rules accept (decided
    JVM-side, once per attempt).  ``valid``: ``label_map_valid`` of the column ``_map``, where a run has built it already."""
    from walletflow.functions.jsonmap import parsed_once
    from walletflow.functions.once import evaluate_once
    from walletflow.operators import labels as L
    from walletflow.operators import portfolio as P

    if opts.kind == "labels":
        doc_ok = L.label_map_valid(F.col("_map")) if valid is None else valid
        staged = evaluate_once(parsed_once(attempts, "_map", F.col("body"), LOOSE_MAP_DDL), "_doc_ok", doc_ok).drop("_map")
    else:
        staged = P.parse_portfolio(attempts, "body").drop("portfolio_doc").withColumnRenamed("portfolio_ok", "_doc_ok")
    ok = F.coalesce(F.col("http_ok") & F.col("body").isNotNull() & F.col("_doc_ok"), F.lit(False))
    out = staged.withColumn("ok", ok).drop("_doc_ok")
    return out.withColumn(
        "error_message", F.when(~F.col("ok"), F.lit(opts.no_data_message))
    ).withColumn(
        "status", F.when(F.col("http_ok") & ~F.col("ok"), F.lit("invalid_document")).otherwise(F.col("status"))
    )


@dataclass
class FetchRun:
    """Result of ``fetch_rounds``: everything is read back from the landing folder."""

    spark: SparkSession
    landing: str
    rounds: int
    opts: FetchOptions
    round_counts: list = field(default_factory=list)   # (round, attempted, failed)
    elapsed_sec: float = 0.0                            # wall time of all rounds (A2)

    def attempts(self) -> DataFrame:
        """All landed attempts, one row per (address, round).  Failed ones hold the context that the
        next round needs, unless contexts are kept where they are staged (``IN_PLACE_BYTES``)."""
        if self.rounds == 0:  # nothing was pending: nothing was landed
            return self.spark.createDataFrame([], LANDED_SCHEMA)
        return self.spark.read.schema(LANDED_SCHEMA).parquet(self.landing)

    def rates(self) -> DataFrame:
        """The rate of every wave, what it met and the rate decided for the next one."""
        if self.rounds == 0 or self.opts.calls_per_sec is None:
            return self.spark.createDataFrame([], RATE_SCHEMA)
        return self.spark.read.schema(RATE_SCHEMA).parquet(f"{self.landing}/_rates")

    def successes(self) -> DataFrame:
        """K7: bag union of the successes of every round (one per address)."""
        return self.attempts().filter("ok")

    @property
    def n_success(self) -> int:
        return sum(attempted - failed for _, attempted, failed in self.round_counts)

    def dead_letters(self) -> DataFrame:
        """K8: staged keys without a success, with their last attempt, numbered 1..n by address."""
        from walletflow.operators.numbering import dense_number

        tried = self.attempts().groupBy("address").agg(
            F.bool_or("ok").alias("done"),
            F.max_by(F.struct("attempt", "status", "error_message"), "attempt").alias("last"),
        )
        if self.rounds == 0:
            open_keys = tried
        else:
            staged = self.spark.read.schema(KEY_SCHEMA).parquet(_staged_keys(self.landing)).select(F.col("address").alias("key"))
            open_keys = staged.join(tried, F.col("key").eqNullSafe(F.col("address")), "left").select(
                F.col("key").alias("address"), "done", "last"
            )
        rows = open_keys.where(~F.coalesce("done", F.lit(False))).select(
            "address",
            F.coalesce(F.col("last.attempt"), F.lit(0)).cast("bigint").alias("attempts"),
            F.col("last.status").alias("last_status"),
            F.coalesce("last.error_message", F.lit(self.opts.no_data_message)).alias("last_error"),
        )
        return dense_number(rows, ["address"], "no")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def _staged_keys(landing: str) -> str:
    return f"{landing}/_pending/round=1/all"


def _in_place_mark(landing: str) -> str:
    return f"{landing}/_pending/_in_place"


def _manifest(distinct: DataFrame, opts: FetchOptions) -> DataFrame:
    """What a landing was started with: the key set's size and order-free fingerprint, the kind
    and the as-of."""
    return distinct.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.xxhash64("address").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("fingerprint"),
    ).select("*", F.lit(opts.kind).alias("kind"), F.lit(opts.as_of_ms).cast("bigint").alias("as_of_ms"))


def landed_as_of(spark: SparkSession, landing: str) -> int | None:
    """The as-of that a landing was started with, if it was started."""
    path = f"{landing.rstrip('/')}/_pending/manifest"
    return spark.read.parquet(path).first()["as_of_ms"] if path_exists(spark, f"{path}/_SUCCESS") else None


def _same_run(spark: SparkSession, landing: str, distinct: DataFrame, opts: FetchOptions) -> None:
    """Raise unless the landing was started with these keys, this kind and this as-of."""
    path = f"{landing}/_pending/manifest"
    if path_exists(spark, f"{path}/_SUCCESS"):
        held = spark.read.parquet(path).first().asDict()
    else:  # started before its manifest was written: the staged keys tell
        held = _manifest(spark.read.parquet(_staged_keys(landing)), opts).first().asDict()
    now = _manifest(distinct, opts).first().asDict()
    differ = sorted(k for k in now if now[k] != held[k])
    if differ:
        raise ValueError(f"landing {landing} belongs to another run: {', '.join(differ)} differ; use a new landing")


def _waves_of(spark: SparkSession, landing: str, r: int, computed: int) -> int:
    """Waves of a round: those it was started with, whatever the options are now."""
    staged = f"{landing}/_pending/round={r}/waves"
    if path_exists(spark, f"{staged}/_SUCCESS"):
        return int(spark.read.parquet(staged).agg(F.max("wave")).first()[0]) + 1
    return 1 if path_exists(spark, f"{landing}/round={r}/wave=0") else computed


def _staged_files(n_keys: int, bytes_per_key: float, waves: int) -> int:
    """Files per wave, each of at most about ``STAGED_KEYS`` keys and ``STAGED_BYTES`` bytes."""
    per_wave = n_keys / waves
    return max(1, math.ceil(per_wave / STAGED_KEYS), math.ceil(per_wave * bytes_per_key / STAGED_BYTES))


def _in_waves(pending: DataFrame, waves: int, files: int) -> DataFrame:
    """The keys with their ``wave``, a task per file.  The file's number is the task's: hashed numbers
    meet in one task, and the more files there are, the more of them."""
    part = F.pmod(F.hash("address"), F.lit(files))
    staged = pending.withColumn("wave", F.pmod(F.xxhash64("address"), F.lit(waves)))
    return staged.repartitionById(waves * files, (F.col("wave") * files + part).cast("int"))


def _land_wave(spark: SparkSession, src: DataFrame, fetch, r: int, opts: FetchOptions, parts: int,
               spread: bool, out: str, rate: float | None = None, valid: Column | None = None,
               echo: bool = True) -> tuple[int, int, int]:
    """Fetch one wave and land it; returns (attempted, failed, throttled).  A wave that
    is already landed (``_SUCCESS``, e.g. before a driver restart) is not
    fetched again."""
    if path_exists(spark, f"{out}/_SUCCESS"):
        got = spark.read.schema(LANDED_WAVE_SCHEMA).parquet(out).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("status") == "429").alias("throttled")
        ).first()
        return int(got["n"]), int(got["failed"] or 0), int(got["throttled"] or 0)
    attempts = with_success(fetch_once(src, fetch, r, opts, parts, spread=spread, rate=rate, echo=echo), opts, valid)
    attempts = attempts.withColumn("context", F.when(~F.col("ok"), F.col("context")))  # only a retry needs it
    obs = Observation(f"wave_{r}_{uuid.uuid4().hex[:6]}")
    attempts = attempts.observe(
        obs, F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("status") == "429").alias("throttled")
    )
    attempts.write.options(**COMPACT).mode("overwrite").parquet(out)
    stats = obs.get
    return tuple(int(stats.get(c, 0) or 0) for c in ("n", "failed", "throttled"))


def _land_waves(spark: SparkSession, src: DataFrame, fetch, r: int, opts: FetchOptions, waves: list[int],
                landed: str, valid: Column | None = None, echo: bool = True) -> tuple[int, int, int]:
    """``_land_wave`` for several waves in one job; ``src`` holds their keys in its tasks already.  Every wave lands
    in its own folder, marked as landed (``_SUCCESS``) when the job is through; what a job that
    died has left is replaced."""
    ship_package(spark)
    schema = T.StructType([*ATTEMPT_SCHEMA.fields, T.StructField("wave", T.IntegerType())])
    fetched = src.select("address", "context", "wave").mapInPandas(_fetch_partitions(fetch, r, opts, keep=("wave",), echo=echo), schema)
    attempts = with_success(fetched, opts, valid).withColumn("context", F.when(~F.col("ok"), F.col("context")))
    obs = Observation(f"waves_{r}_{uuid.uuid4().hex[:6]}")
    attempts.select(*[c for c in attempts.columns if c != "wave"], "wave").observe(
        obs, F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("status") == "429").alias("throttled")
    ).write.options(**COMPACT).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("wave").parquet(landed)
    stats = obs.get
    for w in waves:
        folders.touch(spark, f"{landed}/wave={w}/_SUCCESS")
    return tuple(int(stats.get(c, 0) or 0) for c in ("n", "failed", "throttled"))


def _landed_counts(spark: SparkSession, landed: str, waves: list[int]) -> tuple[int, int]:
    """(attempted, failed) of waves that lie there already."""
    got = spark.read.schema(LANDED_ROUND_SCHEMA).parquet(landed).where(F.col("wave").isin(waves)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("failed")
    ).first()
    return int(got["n"]), int(got["failed"] or 0)


def _still_open(staged: DataFrame, failed: DataFrame | None, chosen: Column) -> DataFrame:
    """The keys of the chosen waves, read where they are staged (address, context, wave): all of them, or
    those of ``failed`` (address, wave)."""
    keys = staged.where(chosen)
    if failed is None:
        return keys
    again = failed.where(chosen).select(F.col("address").alias("_failed"))
    return keys.join(F.broadcast(again), F.col("address").eqNullSafe(F.col("_failed")), "left_semi")


def _fetch_waves(spark: SparkSession, staged: str, landed: str, fetch, r: int, opts: FetchOptions, parts: int,
                 together: int, valid: Column | None, in_place=None, most: int | None = None) -> tuple[int, int, int]:
    """The waves of a round that are not landed yet, ``together`` of them in the next job: twice as many after a
    job that took less than half of ``WAVE_SECONDS``, half after one that took longer than that, ``most`` at most.
    ``in_place``: the keys of the waves that a condition chooses, read where they are staged.
    Returns (attempted, failed, together)."""
    all_keys = None if in_place else spark.read.schema(f"{KEY_SCHEMA}, wave int").parquet(staged)  # the folder is listed once
    held = sorted(int(n[5:]) for n, _ in folders.subfolders(spark, staged) if n.startswith("wave="))
    done = [w for w in held if path_exists(spark, f"{landed}/wave={w}/_SUCCESS")]
    attempted, failed = _landed_counts(spark, landed, done) if done else (0, 0)
    todo = sorted(set(held) - set(done))
    while todo:
        together = min(together, most or together)
        waves, todo = todo[:together], todo[together:]
        began = time.monotonic()
        chosen = F.col("wave").between(waves[0], waves[-1])
        if waves[-1] - waves[0] >= len(waves):  # some of them are landed, or hold no key
            chosen = chosen & F.col("wave").isin(waves)
        keys = in_place(chosen).coalesce(parts) if in_place else _dealt(all_keys.where(chosen), waves[0], len(waves), parts)
        counts = _land_waves(spark, keys, fetch, r, opts, waves, landed, valid, echo=in_place is None)
        attempted, failed = attempted + counts[0], failed + counts[1]
        took = time.monotonic() - began
        if took < WAVE_SECONDS / 2 and len(waves) == together:
            together *= 2
        elif took > WAVE_SECONDS:
            together = max(1, together // 2)
    return attempted, failed, together


RATE_SCHEMA = "round int, wave int, rate double, attempted long, throttled long, next_rate double"


def _next_rate(opts: FetchOptions, rate: float, attempted: int, throttled: int) -> float:
    if throttled > opts.throttled_share * attempted:
        return rate * opts.slow_down
    return min(opts.calls_per_sec, rate * opts.speed_up)


def _decided_rate(spark: SparkSession, landing: str, r: int, w: int, rate: float, counts: tuple, opts: FetchOptions) -> float:
    """The rate after a wave; decided and landed once per wave."""
    path = f"{landing}/_rates/round={r}/wave={w}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        attempted, _, throttled = counts
        row = (rate, attempted, throttled, _next_rate(opts, rate, attempted, throttled))
        spark.createDataFrame([row], "rate double, attempted long, throttled long, next_rate double").coalesce(1).write.mode("overwrite").parquet(path)
        return row[-1]
    return float(spark.read.parquet(path).first()["next_rate"])


def fetch_rounds(keys: DataFrame, fetch, opts: FetchOptions | None = None, *,
                 landing: str | None = None, context: str | None = None, unique: bool = False) -> FetchRun:
    """K5/K6: retry rounds until nothing fails or ``max_rounds`` is reached.

    ``keys`` holds ``address`` (duplicates allowed: each distinct key is
    fetched once, D6) and optionally a ``context`` column handed to the
    fetch function.  ``unique``: no address comes twice.

    A round larger than ``max_partitions x keys_per_partition`` keys runs in
    waves: the pending keys are written partitioned by
    ``pmod(xxhash64(address), waves)`` and each job has at most
    ``max_partitions`` tasks.  A job is one wave; where calls are so quick that it
    would end in less than half of ``WAVE_SECONDS``, the next takes twice as many waves.  A
    lost task re-fetches at most ``keys_per_partition`` keys, or what a task
    fetches in about that time, and a rerun with the same ``landing``
    resumes: landed waves are not fetched again.  Large contexts stay in the waves of
    the first round (``IN_PLACE_BYTES``).
    """
    opts = opts or FetchOptions()
    spark = keys.sparkSession
    landing = (landing or scratch_path(spark, f"landing-{opts.kind}")).rstrip("/")
    ctx = F.col(context) if context else F.lit(None).cast("string")
    distinct = keys.select(F.col("address").cast("string").alias("address"), ctx.alias("context"))
    # texts of other types may be equal
    if not (unique and isinstance(keys.schema["address"].dataType, T.StringType)):
        distinct = distinct.dropDuplicates(["address"])
    per_wave = max(1, opts.max_partitions * max(1, opts.keys_per_partition))
    run = FetchRun(spark, landing, 0, opts)
    started = time.monotonic()
    # The distinct keys are staged once (the de-duplication shuffle runs once,
    # and a resumed run sees the same key set); the count is observed while
    # writing.
    first = _staged_keys(landing)
    if path_exists(spark, f"{first}/_SUCCESS"):
        _same_run(spark, landing, distinct, opts)
        n_pending = spark.read.schema(KEY_SCHEMA).parquet(first).count()
    else:
        obs = Observation(f"keys_{uuid.uuid4().hex[:6]}")
        figures = F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("context")).alias("bytes")
        distinct.observe(obs, *figures).write.options(**COMPACT).mode("overwrite").parquet(first)
        n_pending, held = (int(obs.get.get(c, 0) or 0) for c in ("n", "bytes"))
        _manifest(spark.read.parquet(first), opts).write.mode("overwrite").parquet(f"{landing}/_pending/manifest")
        large = held and held >= IN_PLACE_BYTES * n_pending
        if large and per_wave <= IN_PLACE_KEYS:  # a landing stays as it was started, whatever the options are now
            folders.touch(spark, _in_place_mark(landing))
    pending = spark.read.schema(KEY_SCHEMA).parquet(first) if n_pending else distinct
    n_keys = n_pending
    in_place = n_pending > 0 and path_exists(spark, _in_place_mark(landing))
    own = one_file_a_task(spark) if in_place else spark
    in_waves = failures = read = most = None  # where contexts stay in place: the staged keys, those that failed in the round before
    rate = opts.calls_per_sec
    valid = None
    if opts.kind == "labels":
        from walletflow.operators.labels import label_map_valid

        valid = label_map_valid(F.col("_map"))
    together = 1
    for r in range(1, opts.max_rounds + 1):
        if n_pending is None:
            n_pending = pending.count()
        if n_pending == 0:
            break
        if in_waves is None:
            waves = _waves_of(spark, landing, r, max(1, math.ceil(n_pending / per_wave)))
        parts = _tasks(spark, math.ceil(n_pending / waves), opts)
        if in_place:
            staged = f"{landing}/_pending/round=1/waves"
            if not path_exists(spark, f"{staged}/_SUCCESS"):
                files = max(parts, _staged_files(n_keys, path_size(spark, first) / n_keys, waves))
                _in_waves(pending, waves, files).write.options(**COMPACT).mode("overwrite").partitionBy("wave").parquet(staged)
                release_shuffles(spark, staged)
            if in_waves is None:
                in_waves = own.read.schema(f"{KEY_SCHEMA}, wave int").parquet(staged)
            read = partial(_still_open, in_waves, failures)
            most = max(1, IN_PLACE_KEYS * waves // n_pending) if failures is not None else None
            sources = ((w, read(F.col("wave") == w), False) for w in range(waves) if path_exists(spark, f"{staged}/wave={w}"))
        elif waves == 1:
            sources = [(0, pending, r == 1)]
        else:
            staged = f"{landing}/_pending/round={r}/waves"
            if not path_exists(spark, f"{staged}/_SUCCESS"):
                # a wave then lists and reads its own folder only
                files = _staged_files(n_pending, path_size(spark, first) / n_keys, waves)
                _in_waves(pending, waves, files).write.options(**COMPACT).mode("overwrite").partitionBy("wave").parquet(staged)
            sources = (
                (w, spark.read.schema(KEY_SCHEMA).parquet(f"{staged}/wave={w}"), True)
                for w in range(waves)
                if path_exists(spark, f"{staged}/wave={w}")  # no key may fall into a wave
            )
        attempted = failed = 0
        if (in_place or waves > 1) and rate is None:  # a paced run decides after every wave
            attempted, failed, together = _fetch_waves(
                spark, staged, f"{landing}/round={r}", fetch, r, opts, parts, together, valid, read, most
            )
            sources = ()
        for w, src, spread in sources:
            counts = _land_wave(spark, src, fetch, r, opts, parts, spread, f"{landing}/round={r}/wave={w}", rate, valid, not in_place)
            if rate is not None:
                rate = _decided_rate(spark, landing, r, w, rate, counts, opts)
            attempted += counts[0]
            failed += counts[1]
        run.rounds = r
        run.round_counts.append((r, attempted, failed))
        retry = ~F.col("ok")
        if opts.no_retry:
            retry = retry & ~F.col("status").isin(list(opts.no_retry))
        landed = own.read.schema(LANDED_ROUND_SCHEMA).parquet(f"{landing}/round={r}").filter(retry)
        if in_place:
            failures = landed.select("address", "wave")
        pending = landed.select("address", "context")
        n_pending = failed if not opts.no_retry else None
        if n_pending == 0:
            break
        if r < opts.max_rounds and opts.round_delay:
            time.sleep(opts.round_delay)
    run.elapsed_sec = round(time.monotonic() - started, 3)
    return run


def attach_keys(keys: DataFrame, rows: DataFrame, on: str = "address") -> DataFrame:
    """Give every input key (duplicates included) its fetched rows.

    A plain equi-join: AQE turns it into a broadcast join when the fetched
    side is small at run time and splits skewed keys otherwise.
    """
    return keys.join(rows, on=on, how="inner")
