"""The label and portfolio jobs as functions on DataFrames.

Label job:  ensure table -> keys -> fetch rounds -> flatten -> number ->
            CSV, and the same rows typed and appended (history tagged with the run date).
Portfolio job: ensure table -> keys -> fetch rounds -> flatten -> CSV ->
            full refresh (new version swapped in only after it is written).

Deliberate differences from the reference: a failed table create stops the
job (D4); a refresh with nothing to load keeps the old rows unless
``allow_empty_refresh`` (D3); duplicate keys are fetched once and joined
back for their multiplicity (D6); ``no`` follows (round, address, input
position) rather than completion order (D1); one as-of per batch (D2).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletflow.operators import labels as L
from walletflow.operators import portfolio as P
from walletflow.operators.fetch import attach_keys, fetch_rounds, FetchOptions, FetchRun, landed_as_of
from walletflow.operators.numbering import dense_number
from walletflow.functions.text import default_file_name_text, with_csv_suffix
from walletflow.schemas import (
    LABEL_COLUMNS,
    LABEL_FILE_PREFIX,
    LABEL_TABLE_SCHEMA,
    PORTFOLIO_COLUMNS,
    PORTFOLIO_FILE_PREFIX,
    PORTFOLIO_TABLE_SCHEMA,
)
from walletflow.session import COMPACT, prepare, release_shuffles, scratch_path
from walletflow.sinks import tables
from walletflow.sinks.csv import path_size, write_csv


COPIES = "_walletflow_copies"  # of pinned keys: the rows of an address
AT_ONCE = 1000  # of them, made at a time


class JobStopped(RuntimeError):
    pass


def _csv_path(spark: SparkSession, csv_dir: str | None, filename: str | None, prefix: str) -> str:
    """E3: '<dir>/<name>.csv' with a timestamped default name; the CSV is a
    directory of part files written in parallel."""
    name = with_csv_suffix(filename) if filename else default_file_name_text(prefix)
    return f"{(csv_dir or scratch_path(spark, 'csv')).rstrip('/')}/{name}"


def _write_dead_letters(run: FetchRun, path: str | None) -> None:
    """K8: keys still failing after the last round, appended with the run's landing folder."""
    if path:
        run.dead_letters().withColumn("landing", F.lit(run.landing)).write.mode("append").parquet(path)


@dataclass
class JobResult:
    table: str
    csv_path: str | None
    rows_written: int
    fetch: FetchRun | None
    load: tables.LoadResult | None


def landed_rows(rows: DataFrame, name: str) -> DataFrame:
    """The job's flat rows, evaluated once: the CSV and the load read them from the shared folder."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.options(**COMPACT).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pinned(keys: DataFrame, context: str | None = None) -> DataFrame:
    """The keys, written once to the shared folder: the fetch, the join back and the emptiness check
    see the same rows, whatever becomes of their source meanwhile.  One row per address, with one of its
    contexts (D6) and the number of its rows (``COPIES``), so that contexts are gathered by address only here."""
    path = scratch_path(keys.sparkSession, "job-keys")
    held = [F.first(context).alias(context)] if context else []
    once = keys.groupBy("address").agg(*held, F.count(F.lit(1)).alias(COPIES))
    once.write.options(**COMPACT).parquet(path)
    schema = once.schema
    del once
    release_shuffles(keys.sparkSession, path)
    return keys.sparkSession.read.schema(schema).parquet(path)


def _every_row(keys: DataFrame) -> DataFrame:
    """(address) of every row of the keys.  Copies that ``pinned`` has counted are made in two steps, so that no
    array grows with their number."""
    if COPIES not in keys.columns:
        return keys.select("address")
    rows = keys.select("address", COPIES, F.explode(F.sequence(F.lit(0), F.floor((F.col(COPIES) - 1) / AT_ONCE))).alias("_at"))
    some = F.least(F.lit(AT_ONCE), F.col(COPIES) - F.col("_at") * AT_ONCE)
    return rows.select("address", F.explode(F.sequence(F.lit(1), some)).alias("_copy")).select("address")


def label_rows_for_table(successes: DataFrame, keys: DataFrame, run_date: str) -> DataFrame:
    """Flatten fetched label documents and lay them out as the 11 table columns."""
    flat = L.flatten_labels(L.parse_labels(successes.select("address", "round", "body")), keep=["round"])
    rows = attach_keys(_every_row(keys).select("address", F.monotonically_increasing_id().alias("_pos")), flat)
    numbered = dense_number(rows, ["round", "address", "_pos"], "no")
    return numbered.select(
        F.col("no").cast("int").alias("no"),
        "address", "name", "type", "label",
        F.col("isUserAddress").alias("isuseraddress"),
        "website", "twitter", "crunchbase", "linkedin",
        F.lit(run_date).cast("date").alias("update_date"),
    ).select(*LABEL_COLUMNS)


def enrich_labels(keys: DataFrame, fetch, opts: FetchOptions | None = None, *, context: str | None = None,
                  run_date: str | None = None, landing: str | None = None) -> tuple[DataFrame, FetchRun]:
    """J3 as a DataFrame call: keys -> fetch rounds -> the 11-column label rows."""
    prepare(keys.sparkSession)
    opts = replace(opts or FetchOptions(), kind="labels")
    run = fetch_rounds(keys, fetch, opts, context=context, landing=landing, unique=COPIES in keys.columns)
    rows = label_rows_for_table(run.successes(), keys, run_date or dt.date.today().isoformat())
    return rows, run


def enrich_portfolios(keys: DataFrame, fetch, as_of_ms: int | None = None, opts: FetchOptions | None = None, *,
                      context: str | None = None, landing: str | None = None) -> tuple[DataFrame, FetchRun]:
    """J4 as a DataFrame call: keys -> fetch rounds (one as-of for the batch) -> token rows."""
    prepare(keys.sparkSession)
    opts = replace(opts or FetchOptions(), kind="portfolio")
    if opts.as_of_ms is None:
        before = landed_as_of(keys.sparkSession, landing) if landing else None
        opts.as_of_ms = as_of_ms or before or int(dt.datetime.now().timestamp() * 1000)
    run = fetch_rounds(keys, fetch, opts, context=context, landing=landing, unique=COPIES in keys.columns)
    return portfolio_rows_for_table(run.successes(), keys), run


def export_labels(keys: DataFrame, fetch, opts: FetchOptions | None = None, *, context: str | None = None,
                  csv_dir: str | None = None, filename: str | None = None) -> str | None:
    """CSV path of the label export, or None when there is nothing to write."""
    keys = pinned(keys, context)
    if keys.isEmpty():
        return None
    rows, _ = enrich_labels(keys, fetch, opts, context=context)
    path = _csv_path(keys.sparkSession, csv_dir, filename, LABEL_FILE_PREFIX)
    return path if write_csv(rows, path, mode="overwrite") > 0 else None


def export_portfolios(keys: DataFrame, fetch, as_of_ms: int | None = None, opts: FetchOptions | None = None, *,
                      context: str | None = None, csv_dir: str | None = None,
                      filename: str | None = None) -> str | None:
    """CSV path of the portfolio export, or None when there is nothing to write."""
    keys = pinned(keys, context)
    if keys.isEmpty():
        return None
    rows, _ = enrich_portfolios(keys, fetch, as_of_ms, opts, context=context)
    path = _csv_path(keys.sparkSession, csv_dir, filename, PORTFOLIO_FILE_PREFIX)
    return path if write_csv(rows, path, mode="overwrite") > 0 else None


def label_job(spark: SparkSession, keys: DataFrame, fetch, *, namespace: str, name: str,
              description: str = "Wallet labels", run_date: str | None = None,
              opts: FetchOptions | None = None, context: str | None = None,
              table_root: str | None = None, csv_dir: str | None = None, filename: str | None = None,
              history: bool = False, reject_path: str | None = None,
              dead_letter_path: str | None = None, landing: str | None = None) -> JobResult | None:
    """J1.  Pass ``landing`` (a shared path) to resume a run after a driver
    restart: rounds and waves already landed are not fetched again."""
    prepare(spark)
    full = f"{namespace}.{name}"
    if not tables.create_table(spark, namespace, name, description, LABEL_TABLE_SCHEMA, root=table_root,
                               partition_by=["update_date"] if history else None):
        raise JobStopped(f"could not create {full}")
    keys = pinned(keys, context)
    if keys.isEmpty():
        return None
    rows, run = enrich_labels(keys, fetch, opts, context=context, run_date=run_date, landing=landing)
    rows = landed_rows(rows, "label-rows")
    _write_dead_letters(run, dead_letter_path)
    csv_path = _csv_path(spark, csv_dir, filename, LABEL_FILE_PREFIX)
    written = write_csv(rows, csv_path, mode="overwrite")
    if written == 0:
        return JobResult(full, None, 0, run, None)
    # The load id stands for the landing: a run over a landing that this table has loaded does not
    # append again, and one whose load was refused or died can be repeated.
    load_id = None if history else hashlib.sha256(run.landing.encode()).hexdigest()[:24]
    load = tables.load_rows(spark, rows, namespace, name, mode="history" if history else "append",
                            reject_path=reject_path, size=path_size(spark, csv_path), load_id=load_id)
    return JobResult(full, csv_path, written, run, None if load.repeated else load)


def portfolio_rows_for_table(successes: DataFrame, keys: DataFrame) -> DataFrame:
    parsed = P.parse_portfolio(successes.select("address", "body"))
    flat = P.flatten_portfolio(parsed)
    rows = attach_keys(_every_row(keys), flat)
    return rows.select(*PORTFOLIO_COLUMNS)


def portfolio_job(spark: SparkSession, keys: DataFrame, fetch, *, namespace: str, name: str,
                  description: str = "Wallet portfolios", as_of_ms: int | None = None,
                  opts: FetchOptions | None = None, context: str | None = None,
                  table_root: str | None = None, csv_dir: str | None = None, filename: str | None = None,
                  allow_empty_refresh: bool = False, reject_path: str | None = None,
                  dead_letter_path: str | None = None, landing: str | None = None) -> JobResult | None:
    """J2.  ``landing`` as for ``label_job``; pass ``as_of_ms`` too when resuming, so
    every round uses the same as-of."""
    prepare(spark)
    full = f"{namespace}.{name}"
    if not tables.create_table(spark, namespace, name, description, PORTFOLIO_TABLE_SCHEMA, root=table_root):
        raise JobStopped(f"could not create {full}")
    keys = pinned(keys, context)
    if keys.isEmpty():
        return None
    # One as-of for the whole batch, taken once on the driver.
    rows, run = enrich_portfolios(keys, fetch, as_of_ms, opts, context=context, landing=landing)
    rows = landed_rows(rows, "portfolio-rows")
    _write_dead_letters(run, dead_letter_path)
    csv_path = _csv_path(spark, csv_dir, filename, PORTFOLIO_FILE_PREFIX)
    written = write_csv(rows, csv_path, mode="overwrite")
    # Wallets without tokens are a result; only calls that all failed are none.
    if run.n_success == 0 and not allow_empty_refresh:
        return JobResult(full, None, 0, run, None)
    load = tables.load_rows(spark, rows, namespace, name, mode="refresh", reject_path=reject_path,
                            size=path_size(spark, csv_path))
    return JobResult(full, csv_path, written, run, load)
