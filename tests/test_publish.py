"""Loads are staged, audited and published."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletflow.operators.fetch import FetchOptions, FetchRequest
from walletflow.plans.jobs import label_job, portfolio_job
from walletflow.sinks import folders, tables

FAST = dict(request_delay=0.0, backoff_429=0.0, round_delay=0.0)
ONE = T.StructType([T.StructField("a", T.LongType())])
DAYS = T.StructType([T.StructField("a", T.LongType()), T.StructField("day", T.DateType())])


def made(spark, tmp_dir, schema=ONE, partition_by=None, root=True):
    ns = f"pub_{os.path.basename(tmp_dir).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{tmp_dir}/{ns}'")
    assert tables.create_table(spark, ns, "t", "d", schema, root=f"{tmp_dir}/data" if root else None, partition_by=partition_by)
    return ns


def values(spark, ns):
    return sorted(r.a for r in spark.table(f"{ns}.t").collect())


def rows(spark, *cells):
    return spark.createDataFrame([(c,) for c in cells], "a string")


def test_refused_refresh_keeps_the_old_rows(spark, tmp_dir):
    ns = made(spark, tmp_dir)
    assert tables.load_rows(spark, rows(spark, "1", "2"), ns, "t", mode="refresh").ok
    for audit in (tables.Audit(), tables.Audit(max_lost=5)):  # also where the rejects may be lost
        bad = tables.load_rows(spark, rows(spark, "x", "y"), ns, "t", mode="refresh", audit=audit)
        assert not bad.ok and bad.problems and bad.rejected == 2 and values(spark, ns) == [1, 2]
    few = tables.load_rows(spark, rows(spark, "7"), ns, "t", mode="refresh", audit=tables.Audit(least_share=0.9))
    assert not few.ok and values(spark, ns) == [1, 2]
    broken = tables.load_rows(spark, rows(spark, "7", None), ns, "t", mode="refresh", audit=tables.Audit(checks={"a": "a > 0"}))
    assert broken.problems == ["a: broken by 1 rows"] and values(spark, ns) == [1, 2]
    assert not folders.subfolders(spark, f"{tmp_dir}/data/_staging")  # nothing is left of refused loads
    assert tables.load_rows(spark, rows(spark, "7"), ns, "t", mode="refresh").ok and values(spark, ns) == [7]


@pytest.mark.parametrize("partition_by", [None, ["day"]])
def test_load_that_dies_keeps_the_old_rows(spark, tmp_dir, partition_by):
    ns = made(spark, tmp_dir, DAYS, partition_by)
    day = dt.date(2024, 1, 14)
    old = spark.createDataFrame([(1, day), (2, day + dt.timedelta(1))], "a long, day date")
    assert tables.load_rows(spark, old, ns, "t", mode="refresh").ok
    dies = spark.range(0, 50, 1, 5).select(
        F.expr("if(id = 49, raise_error('lost'), id)").cast("long").alias("a"), F.expr("date'2024-02-01' + cast(id % 3 as int)").alias("day")
    )
    for mode in ("refresh", "append", "history" if partition_by else "append"):
        with pytest.raises(Exception, match="lost"):
            tables.load_rows(spark, dies, ns, "t", mode=mode)
        assert values(spark, ns) == [1, 2]


def test_one_pointer_for_all_partitions(spark, tmp_dir):
    ns = made(spark, tmp_dir, DAYS, ["day"])
    day = dt.date(2024, 1, 14)
    frame = lambda *r: spark.createDataFrame([(a, day + dt.timedelta(d)) for a, d in r], "a long, day date")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode"), spark.conf.get("spark.sql.hive.manageFilesourcePartitions")
    assert tables.load_rows(spark, frame((1, 0), (2, 1)), ns, "t", mode="history").ok
    assert tables.load_rows(spark, frame((3, 1)), ns, "t", mode="history").ok
    assert values(spark, ns) == [1, 3]  # only the second day was replaced
    assert tables.load_rows(spark, frame((4, 5)), ns, "t", mode="refresh").ok and values(spark, ns) == [4]
    assert tables.load_rows(spark, frame((5, 5)), ns, "t").ok and values(spark, ns) == [4, 5]
    assert before == (spark.conf.get("spark.sql.sources.partitionOverwriteMode"), spark.conf.get("spark.sql.hive.manageFilesourcePartitions"))
    plan = spark.table(f"{ns}.t").where("day = date'2024-01-19'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    with pytest.raises(ValueError):
        tables.load_rows(spark, frame((5, 5)), ns, "t", load_id="x")


def test_versions_are_kept_and_removed(spark, tmp_dir):
    ns = made(spark, tmp_dir)
    for i in range(5):
        assert tables.load_rows(spark, rows(spark, str(i)), ns, "t", mode="refresh", keep=3).ok
    assert len([n for n, _ in folders.subfolders(spark, f"{tmp_dir}/data") if n.startswith("v-")]) == 3
    assert tables.clear_table(spark, ns, "t") and values(spark, ns) == []
    assert len([n for n, _ in folders.subfolders(spark, f"{tmp_dir}/data") if n.startswith("v-")]) == tables.KEEP_VERSIONS


def test_table_without_root_goes_with_its_folder(spark, tmp_dir):
    ns = made(spark, tmp_dir, root=False)
    assert tables.load_rows(spark, rows(spark, "1"), ns, "t").ok and tables.load_rows(spark, rows(spark, "2"), ns, "t", mode="refresh").ok
    assert values(spark, ns) == [2] and tables.delete_table(spark, ns, "t") and not folders.exists(spark, f"{tmp_dir}/{ns}/t")
    assert tables.create_table(spark, ns, "t", "d", ONE) and values(spark, ns) == []


def test_load_id_is_published_once(spark, tmp_dir):
    ns = made(spark, tmp_dir)
    load = lambda *cells, **k: tables.load_rows(spark, rows(spark, *cells), ns, "t", load_id="run-1", **k)
    refused = load("1", "x")
    assert not refused.ok and not refused.repeated and values(spark, ns) == []
    kept = load("1", "x", reject_path=f"{tmp_dir}/rejects")
    assert kept.ok and values(spark, ns) == [1] and spark.read.parquet(f"{tmp_dir}/rejects").count() == 1
    again = load("1", "x", reject_path=f"{tmp_dir}/rejects")
    assert again.ok and again.repeated and values(spark, ns) == [1] and spark.read.parquet(f"{tmp_dir}/rejects").count() == 1
    with pytest.raises(ValueError):
        tables.load_rows(spark, rows(spark, "1"), ns, "t", load_id="../x")


def test_crash_before_the_move_leaves_nothing(spark, tmp_dir, monkeypatch):
    ns = made(spark, tmp_dir)

    def crash(*_):
        raise RuntimeError("driver died")

    with monkeypatch.context() as m:
        m.setattr(folders, "move", crash)
        with pytest.raises(RuntimeError):
            tables.load_rows(spark, rows(spark, "1"), ns, "t", load_id="a")
        with pytest.raises(RuntimeError):
            tables.load_rows(spark, rows(spark, "1"), ns, "t", mode="refresh")
    assert values(spark, ns) == []
    assert tables.load_rows(spark, rows(spark, "1"), ns, "t", load_id="a").ok and values(spark, ns) == [1]


def test_repeated_epoch_adds_nothing(spark, tmp_dir):
    ns = made(spark, tmp_dir)
    batch = spark.createDataFrame([(1,), (2,)], ONE)
    assert tables.append_once(spark, batch, f"{ns}.t", "stream-0") and not tables.append_once(spark, batch, f"{ns}.t", "stream-0")
    assert tables.append_once(spark, batch, f"{ns}.t", "stream-1") and values(spark, ns) == [1, 1, 2, 2]


def test_lost_checkpoint_repeats_epochs_without_rows(spark, tmp_dir):
    """A stream whose checkpoint lost its last commit repeats that epoch; its load id is there."""
    import glob

    from walletflow.operators.fetch import fetch_rounds
    from walletflow.plans.stub_service import CyclingStubService
    from walletflow.streaming.landing import load_landed_now

    keys = spark.createDataFrame([("0x" + f"{k:040x}", '{"base":{"arkhamLabel":{"name":"B"}}}') for k in range(12)], "address string, doc string")
    run = fetch_rounds(keys, CyclingStubService(), FetchOptions(kind="labels", max_rounds=3, **FAST), context="doc")
    ns = f"pub_{os.path.basename(tmp_dir).replace('-', '_')}"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("address", "name", "label")])
    assert tables.create_table(spark, ns, "s", "d", schema, root=f"{tmp_dir}/s")
    load_landed_now(spark, run.landing, "labels", f"{ns}.s", f"{tmp_dir}/ckpt")
    first = spark.table(f"{ns}.s").count()
    for commit in glob.glob(f"{tmp_dir}/ckpt/commits/*") + glob.glob(f"{tmp_dir}/ckpt/commits/.*crc"):
        os.remove(commit)
    load_landed_now(spark, run.landing, "labels", f"{ns}.s", f"{tmp_dir}/ckpt")
    assert first == spark.table(f"{ns}.s").count() == run.successes().count() == 3


class OneDocument:
    def __init__(self, body):
        self.body = body

    def __call__(self, req: FetchRequest):
        return 200, self.body


def test_jobs_do_not_seal_or_replace_after_a_refused_load(spark, tmp_dir):
    good, bad = "0x" + "0" * 40, "nothex"
    keys = lambda *a: spark.createDataFrame([(x,) for x in a], "address string")
    where = dict(namespace=f"pub_{os.path.basename(tmp_dir).replace('-', '_')}")
    label = OneDocument('{"base":{"arkhamLabel":{"name":"B"}}}')
    args = dict(name="l", opts=FetchOptions(kind="labels", **FAST), table_root=f"{tmp_dir}/l", landing=f"{tmp_dir}/landing", run_date="2024-01-15")
    first = label_job(spark, keys(good, bad), label, **where, **args)
    assert not first.load.ok and spark.table(f"{where['namespace']}.l").count() == 0
    second = label_job(spark, keys(good, bad), label, **where, **args, reject_path=f"{tmp_dir}/rejects")
    assert second.load.ok and (second.load.rows_written, second.load.rejected) == (1, 1)
    third = label_job(spark, keys(good, bad), label, **where, **args, reject_path=f"{tmp_dir}/rejects")
    assert third.load is None and spark.table(f"{where['namespace']}.l").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 1

    doc = OneDocument('{"ethereum":{"t":{"id":"t","name":"n","symbol":"S","balance":"1","price":"2","usd":"2"}}}')
    args = dict(name="p", opts=FetchOptions(kind="portfolio", **FAST), table_root=f"{tmp_dir}/p")
    assert portfolio_job(spark, keys(good, "0x" + "1" * 40), doc, **where, **args).load.ok
    refused = portfolio_job(spark, keys(bad), doc, **where, **args)
    assert not refused.load.ok and spark.table(f"{where['namespace']}.p").count() == 2
