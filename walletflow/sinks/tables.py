"""Catalog tables and CSV loads, published after an audit.

A table's rows lie in a version folder below its root (``<root>/v-<id>``); the
catalog's location is the pointer to the version that readers see.  A load

1. *stages*: types the text (E7/E8) and writes the good rows to
   ``<root>/_staging/<id>``, counting good rows, rejects and broken checks in the
   same pass;
2. *audits* (``Audit``): rejects that nothing keeps, rows against the rows that the
   load replaces, conditions that every row must meet;
3. *publishes* only what passed.  A refresh moves the staged folder to a new version
   and repoints the table (one catalog operation, also for partitioned tables,
   whose partitions are found below the location).  An append moves the staged
   folder into the current version as ``load-<load id>``: rows and load id become
   visible by one rename, so a load id that is there is done, and one that is not
   can be repeated.  History replaces the partitions that the stage holds.

Whatever fails before the last step leaves the table as it was.  The newest
``keep`` versions stay for readers that still use them; older ones are removed.
A reject is a non-empty cell that does not convert, or an address that is not
``0x`` + an even number of hex digits.

One writer per table at a time: the catalog has no lock.  On storage where a folder
rename is a copy, an append that dies in it leaves a partial folder; there, write
to a table format instead.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from walletflow.functions.address import address_problem, address_to_binary
from walletflow.functions.text import megabytes
from walletflow.sinks import folders
from walletflow.sinks.csv import as_csv_text, file_sizes, read_csv
from walletflow.sources.csv_records import read_csv_splits

KEEP_VERSIONS = 2
SPLIT_BYTES = 128 << 20  # size of a CSV file from which it is read by several tasks


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(spark: SparkSession, namespace: str, name: str, description: str, schema: T.StructType,
                 is_private: bool = False, root: str | None = None, partition_by: list[str] | None = None) -> bool:
    """Create if missing; True if created or already there, False on error.  Without ``root`` the
    table's versions lie in its namespace's folder and go when the table is dropped."""
    full = f"{namespace}.{name}"
    try:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_ident(namespace)}")
        if spark.catalog.tableExists(full):
            return True
        owned = root is None
        if owned:
            home = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE NAMESPACE {_ident(namespace)}").collect()}
            root = f"{home['Location'].rstrip('/')}/{name}"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        if partition_by:
            layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
        else:
            layout = "OPTIONS ('recursiveFileLookup'='true')"  # a version holds one folder per load
        # Partitions are found below the location instead of being listed in the catalog, so that
        # one pointer covers them all.  A session of its own: the setting concerns this statement only.
        own = spark.newSession()
        own.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
        own.sql(
            f"CREATE TABLE IF NOT EXISTS {_ident(full)} ({cols}) USING parquet {layout} "
            f"LOCATION {_lit(_version(root))} COMMENT {_lit(description)} "
            f"TBLPROPERTIES ('is_private'={_lit(str(bool(is_private)).lower())}, "
            f"'walletflow.root'={_lit(root)}, 'walletflow.owned'={_lit(str(owned).lower())}, "
            f"'walletflow.partitions'={_lit(','.join(partition_by or []))})"
        )
        return spark.catalog.tableExists(full)
    except Exception:  # noqa: BLE001 - the contract is a boolean
        return False


def delete_table(spark: SparkSession, namespace: str, name: str) -> bool:
    """T4: drop; False if the table does not exist."""
    full = f"{namespace}.{name}"
    try:
        props = _properties(spark, full)
        spark.sql(f"DROP TABLE {_ident(full)}")
    except AnalysisException:
        return False
    if props.get("walletflow.owned") == "true":
        folders.remove(spark, props["walletflow.root"])
    return True


def _version(root: str) -> str:
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


def _properties(spark: SparkSession, full: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(full)}").collect()}


def has_versions(spark: SparkSession, full: str) -> bool:
    """Whether ``create_table`` made the table."""
    return "walletflow.root" in _properties(spark, full)


def _location(spark: SparkSession, full: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(full)}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"].rstrip("/")


def _point_to(spark: SparkSession, full: str, root: str, location: str, keep: int) -> None:
    """Publish a version, then remove all but the newest ``keep`` (the published one counts)."""
    spark.sql(f"ALTER TABLE {_ident(full)} SET LOCATION {_lit(location)}")
    spark.sql(f"REFRESH TABLE {_ident(full)}")
    current = location.rsplit("/", 1)[-1]
    old = sorted(((t, n) for n, t in folders.subfolders(spark, root) if n.startswith("v-") and n != current), reverse=True)
    for _, name in old[max(keep, 1) - 1 :]:
        folders.remove(spark, f"{root.rstrip('/')}/{name}")


def clear_table(spark: SparkSession, namespace: str, name: str) -> bool:
    """T5: remove all rows, keep the schema: an empty version is published."""
    full = f"{namespace}.{name}"
    try:
        root = _properties(spark, full).get("walletflow.root")
        if root is None:
            spark.sql(f"TRUNCATE TABLE {_ident(full)}")
        else:
            version = _version(root)
            folders.make(spark, version)
            _point_to(spark, full, root, version, KEEP_VERSIONS)
        return spark.table(full).isEmpty()
    except Exception:  # noqa: BLE001
        return False


# ------------------------------------------------------------------ typed load

def _typed(col: str, dtype: T.DataType) -> tuple[Column, Column]:
    """(typed value, reject reason or NULL) for one text column."""
    c = F.col(f"`{col}`")
    if isinstance(dtype, T.BinaryType):
        return address_to_binary(c), F.when(c.isNotNull(), address_problem(c))
    if isinstance(dtype, T.StringType):
        return c, F.lit(None).cast("string")
    typed = F.expr(f"try_cast(`{col}` AS {dtype.simpleString()})")
    return typed, F.when(c.isNotNull() & typed.isNull(), F.lit(f"{col}: not a {dtype.simpleString()}"))


def _staged(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed values, ``_reason`` (empty for a good row) and the text of each row."""
    values, reasons = [], []
    for f in schema.fields:
        v, r = _typed(f.name, f.dataType)
        values.append(v.alias(f.name))
        reasons.append(r)
    return text.select(*values, F.concat_ws("; ", *reasons).alias("_reason"),
                       F.struct(*[F.col(f"`{c}`") for c in text.columns]).alias("_text"))


def type_rows(text: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Text rows -> (typed good rows, rejects with a reason)."""
    staged = _staged(text, schema)
    good = staged.filter(F.col("_reason") == "").select(*[f.name for f in schema.fields])
    rejects = staged.filter(F.col("_reason") != "").select(F.col("_text.*"), F.col("_reason").alias("reject_reason"))
    return good, rejects


@dataclass(frozen=True)
class Audit:
    """What a staged load must meet before it is published."""

    max_lost: int = 0                   # rejected rows that may be lost when no reject path keeps them
    max_rejected: int | None = None     # rejected rows at most, kept or not
    least_share: float | None = None    # refresh: rows at least this share of the rows they replace
    checks: dict[str, str] = field(default_factory=dict)  # name -> SQL condition that every good row meets


@dataclass
class LoadResult:
    ok: bool                    # published, now or by an earlier load of this id
    rows_written: int = 0       # rows that converted; in the table only if ``ok``
    bytes_read: int = 0
    rejects: DataFrame | None = None
    rejected: int = 0           # rows that did not convert
    problems: list[str] = field(default_factory=list)  # why the audit refused the load
    repeated: bool = False      # this load id was published before; nothing was written

    @property
    def megabytes(self) -> float:
        return round(self.bytes_read / (1024 * 1024), 2)


def load_csv(spark: SparkSession, csv_path: str, namespace: str, name: str, mode: str = "append",
             reject_path: str | None = None, max_lost: int = 0, *, load_id: str | None = None,
             audit: Audit | None = None, keep: int = KEEP_VERSIONS, split_bytes: int = SPLIT_BYTES) -> LoadResult:
    """T6 (append) / T7 (refresh) / T8 (history: the partitions that the rows hold are replaced).

    Missing path -> ``LoadResult(False)``.  Rejects are counted always, appended to ``reject_path``
    when given (with a load id written once, to ``<reject_path>/load=<id>``), and returned either
    way.  Rejected rows that are written nowhere are lost: more than ``max_lost`` of them stop the
    load before it is published.  An append with a ``load_id`` that the table holds writes nothing.
    """
    full = f"{namespace}.{name}"
    try:
        sizes = file_sizes(spark, csv_path)
    except FileNotFoundError:
        return LoadResult(False)
    size, schema = sum(sizes), spark.table(full).schema
    # a file that is larger than a task should read is read split by split
    read = read_csv_splits if max(sizes, default=0) > split_bytes else read_csv
    text = read(spark, csv_path, [f.name for f in schema.fields])
    return _load_text(spark, text, full, schema, mode, size, reject_path, audit or Audit(max_lost), load_id, keep)


def load_rows(spark: SparkSession, rows: DataFrame, namespace: str, name: str, mode: str = "append",
              reject_path: str | None = None, max_lost: int = 0, size: int = 0, *, load_id: str | None = None,
              audit: Audit | None = None, keep: int = KEEP_VERSIONS) -> LoadResult:
    """``load_csv`` for rows at hand: typed, split and counted as if they had gone through a CSV
    file (an empty cell is NULL), but nothing is read back.  ``size`` is reported as bytes read."""
    full = f"{namespace}.{name}"
    schema = spark.table(full).schema
    text = as_csv_text(rows.select(*[f.name for f in schema.fields]))
    text = text.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name) for f in schema.fields])
    return _load_text(spark, text, full, schema, mode, size, reject_path, audit or Audit(max_lost), load_id, keep)


def append_once(spark: SparkSession, rows: DataFrame, full: str, load_id: str) -> bool:
    """Append typed rows under a load id; False if the table holds that load already."""
    root = _properties(spark, full).get("walletflow.root")
    if root is None:
        raise ValueError(f"{full} has no versions: create it with create_table")
    target = _load_folder(spark, full, load_id)
    if folders.exists(spark, target):
        return False
    staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    rows.select(*[f.name for f in spark.table(full).schema.fields]).write.parquet(staging)
    folders.move(spark, staging, target)
    spark.sql(f"REFRESH TABLE {_ident(full)}")
    return True


def _load_folder(spark: SparkSession, full: str, load_id: str) -> str:
    if _properties(spark, full).get("walletflow.partitions"):
        raise ValueError(f"{full} is partitioned: load it with mode='history', which can be repeated")
    if not load_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a load id holds letters, digits, - and _")
    return f"{_location(spark, full)}/load-{load_id}"


def _load_text(spark: SparkSession, text: DataFrame, full: str, schema: T.StructType, mode: str, size: int,
               reject_path: str | None, audit: Audit, load_id: str | None, keep: int) -> LoadResult:
    props = _properties(spark, full)
    parts = [c for c in props.get("walletflow.partitions", "").split(",") if c]
    root = props.get("walletflow.root")
    run = load_id or uuid.uuid4().hex
    if mode == "append" and not parts and root and folders.exists(spark, _load_folder(spark, full, run)):
        return LoadResult(True, 0, size, repeated=True)
    if load_id and (parts or not root or mode != "append"):
        raise ValueError("load ids are for appends to tables without partitions; refresh and history can be repeated as they are")
    rejects = type_rows(text, schema)[1]
    # a table that was not made by create_table is staged in the shared scratch folder
    if root:
        staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    else:
        from walletflow.session import scratch_path

        staging = scratch_path(spark, "staging")
    seen = Observation("load")
    writer = _staged(text, schema).observe(seen, *_metrics(audit)).where("_reason = ''").select(*[f.name for f in schema.fields]).write
    (writer.partitionBy(*parts) if parts else writer).parquet(staging)
    counts = seen.get
    result = LoadResult(False, int(counts["rows"]), size, rejects, int(counts["rejected"]))
    if result.rejected and reject_path:
        if load_id:
            rejects.write.mode("overwrite").parquet(f"{reject_path.rstrip('/')}/load={load_id}")
        else:
            rejects.write.mode("append").parquet(reject_path)
    result.problems = _problems(spark, full, mode, result, counts, audit, bool(reject_path))
    if result.problems:
        folders.remove(spark, staging)
        return result
    if not root:
        spark.read.schema(schema).parquet(staging).write.insertInto(full, overwrite=mode != "append")
        folders.remove(spark, staging)
    elif mode == "refresh":
        version = _version(root)
        folders.move(spark, staging, version if parts else f"{version}/load-{run}")
        _point_to(spark, full, root, version, keep)
    elif parts:
        # the stage is read back, so a reader of the table never meets a half-typed load
        rows = spark.read.schema(schema).parquet(staging).write.partitionBy(*parts)
        rows = rows.mode("overwrite").option("partitionOverwriteMode", "dynamic") if mode == "history" else rows.mode("append")
        rows.parquet(_location(spark, full))
        folders.remove(spark, staging)
    else:
        folders.move(spark, staging, _load_folder(spark, full, run))
    spark.sql(f"REFRESH TABLE {_ident(full)}")
    result.ok = True
    return result


def _metrics(audit: Audit) -> list[Column]:
    good = F.col("_reason") == ""
    broken = [F.count_if(good & ~F.coalesce(F.expr(sql), F.lit(False))).alias(f"check_{i}") for i, sql in enumerate(audit.checks.values())]
    return [F.count_if(good).alias("rows"), F.count_if(~good).alias("rejected"), *broken]


def _problems(spark: SparkSession, full: str, mode: str, result: LoadResult, counts: dict, audit: Audit, kept: bool) -> list[str]:
    """What the audit has against a staged load."""
    out = []
    if not kept and result.rejected > audit.max_lost:
        out.append(f"{result.rejected} rejected rows would be lost")
    if audit.max_rejected is not None and result.rejected > audit.max_rejected:
        out.append(f"{result.rejected} rows rejected, {audit.max_rejected} allowed")
    if mode == "refresh" and result.rejected and not result.rows_written:
        out.append("every row was rejected")
    if mode == "refresh" and audit.least_share is not None:
        before = spark.table(full).count()
        if result.rows_written < audit.least_share * before:
            out.append(f"{result.rows_written} rows would replace {before}")
    for i, (name, _) in enumerate(audit.checks.items()):
        if counts[f"check_{i}"]:
            out.append(f"{name}: broken by {counts[f'check_{i}']} rows")
    return out


def load_stats_frame(spark: SparkSession, result: LoadResult) -> DataFrame:
    """A4/E6 as a one-row DataFrame: rows written, bytes read, MB."""
    df = spark.range(1).select(
        F.lit(result.rows_written).cast("bigint").alias("rows_written"),
        F.lit(result.bytes_read).cast("bigint").alias("bytes_written"),
    )
    return df.withColumn("megabytes", megabytes(F.col("bytes_written")))
