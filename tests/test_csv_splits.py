"""Quoted CSV files read split by split."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from walletflow.sinks.csv import read_csv, write_csv
from walletflow.sources.csv_records import csv_records, read_csv_splits

COLUMNS = ["a", "b", "c"]


@pytest.fixture()
def small_splits(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "300")
    own.conf.set("spark.sql.files.openCostInBytes", "100")
    return own


def cells(rnd):
    return rnd.choice(["", "x", "é\U0001f600", "a,b", 'say "hi"', '"', '""', "two\nlines", "win\r\nlines", "\n", "\n\n\n", ' "\n', " spaced ", "0x" + "ab" * 20, "l" * rnd.randrange(700), "many\n" * rnd.randrange(200)])


def write(path, rows, end="\r\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end, quoting=quoting).writerows(rows)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("end, quoting", [("\n", csv.QUOTE_MINIMAL), ("\r\n", csv.QUOTE_MINIMAL), ("\n", csv.QUOTE_ALL)])
def test_splits_give_the_rows_of_the_whole_file(small_splits, tmp_dir, end, quoting):
    rnd = random.Random(len(end) + quoting)
    os.mkdir(f"{tmp_dir}/f")
    rows = []
    for name in ("one", "two"):
        own = [[str(i), cells(rnd), cells(rnd)] for i in range(150)] + [["a", "b", "c"]]  # a row like the header
        write(f"{tmp_dir}/f/{name}.csv", [COLUMNS, *own], end, quoting)
        rows += own
    got = read_csv_splits(small_splits, f"{tmp_dir}/f", COLUMNS)
    assert got.collect() and rows_of(got) == rows_of(small_splits.createDataFrame([[c or None for c in r] for r in rows], "a string, b string, c string"))
    if quoting == csv.QUOTE_MINIMAL and end == "\n":
        assert rows_of(got) == rows_of(read_csv(small_splits, f"{tmp_dir}/f", COLUMNS))


def test_one_file_is_many_tasks(small_splits, tmp_dir):
    path = f"{tmp_dir}/big.csv"
    write(path, [COLUMNS, *[[str(i), "two\nlines", "x" * 40] for i in range(200)]], "\n")
    from walletflow.sources.csv_records import csv_lines

    parts = csv_lines(small_splits, path).select(F.spark_partition_id().alias("p"), "block").distinct()
    assert parts.select("p").distinct().count() > 20 and parts.select("block").distinct().count() > 20
    assert read_csv_splits(small_splits, path, COLUMNS).count() == 200


def test_without_line_ends_in_cells_nothing_is_shuffled(small_splits, tmp_dir):
    path = f"{tmp_dir}/plain.csv"
    write(path, [COLUMNS, *[[str(i), 'q"q', ""] for i in range(100)]])
    records = csv_records(small_splits, path)
    assert records.count() == 101 and records.where("header").count() == 1
    assert "Window" not in records._jdf.queryExecution().optimizedPlan().toString()


def test_headers_and_cell_counts_are_checked(small_splits, tmp_dir):
    write(f"{tmp_dir}/h.csv", [["a", "c", "b"], ["1", "2", "3"]])
    with pytest.raises(Exception, match="header differs"):
        read_csv_splits(small_splits, f"{tmp_dir}/h.csv", COLUMNS).collect()
    write(f"{tmp_dir}/n.csv", [COLUMNS, ["1", "2"]])
    with pytest.raises(Exception, match="[Mm]alformed"):
        read_csv_splits(small_splits, f"{tmp_dir}/n.csv", COLUMNS).collect()
    write(f"{tmp_dir}/e.csv", [COLUMNS])
    assert read_csv_splits(small_splits, f"{tmp_dir}/e.csv", COLUMNS).count() == 0


def test_reads_what_the_sink_writes(small_splits, tmp_dir):
    rnd = random.Random(3)
    df = small_splits.createDataFrame([[cells(rnd) for _ in COLUMNS] for _ in range(200)], "a string, b string, c string")
    write_csv(df, f"{tmp_dir}/out")
    assert rows_of(read_csv_splits(small_splits, f"{tmp_dir}/out", COLUMNS)) == rows_of(read_csv(small_splits, f"{tmp_dir}/out", COLUMNS))


def test_load_reads_large_files_by_splits(small_splits, tmp_dir):
    from pyspark.sql import types as T

    from walletflow.sinks import tables

    ns = f"spl_{os.path.basename(tmp_dir).replace('-', '_')}"
    small_splits.sql(f"CREATE DATABASE {ns} LOCATION '{tmp_dir}/{ns}'")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])
    assert tables.create_table(small_splits, ns, "t", "d", schema)
    write(f"{tmp_dir}/l.csv", [COLUMNS, *[[str(i), "two\nlines", ""] for i in range(100)], ["x", "y", "z"]], "\n")
    result = tables.load_csv(small_splits, f"{tmp_dir}/l.csv", ns, "t", max_lost=1, split_bytes=100)
    assert (result.ok, result.rows_written, result.rejected) == (True, 100, 1)
    assert small_splits.table(f"{ns}.t").where("b = 'two\nlines' and c is null").count() == 100
