"""CSV dialect, typed loads and table operations."""

import csv
import glob
import io
import os

from walletflow.schemas import LABEL_TABLE_SCHEMA
from walletflow.sinks import tables
from walletflow.sinks.csv import as_csv_text, read_csv, write_csv

CELLS = [
    ("  lead", "trail  ", True),
    (None, "", False),
    ('say "hi", ok', "a,b", None),
    ("line1\nline2", "x", True),
]


def test_csv_text_matches_python_writer(spark, tmp_dir):
    df = spark.createDataFrame(CELLS, "a string, b string, c boolean").coalesce(1)
    path = os.path.join(tmp_dir, "out")
    assert write_csv(df, path) == len(CELLS)
    text = "".join(open(f).read() for f in sorted(glob.glob(os.path.join(path, "part-*.csv"))))
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(["a", "b", "c"])
    for row in CELLS:
        w.writerow(["" if v is None else v for v in row])
    assert text == buf.getvalue()


def test_csv_roundtrip_keeps_text(spark, tmp_dir):
    df = spark.createDataFrame(CELLS, "a string, b string, c boolean")
    path = os.path.join(tmp_dir, "rt")
    write_csv(df, path)
    back = sorted((tuple(r) for r in read_csv(spark, path, ["a", "b", "c"]).collect()), key=repr)
    # empty text and NULL both come back as NULL, like the reference's CSV
    exp = sorted((tuple(None if v in (None, "") else v for v in r) for r in as_csv_text(df).collect()), key=repr)
    assert back == exp


def test_typed_load_rejects_bad_cells(spark):
    text = spark.createDataFrame(
        [
            ("1", "0x" + "ab" * 20, "n", "t", "l", "True", "", "", "", "", "2024-01-15"),
            ("x", "0x" + "ab" * 20, "n", "t", "l", "False", "", "", "", "", "2024-01-15"),
            ("2", "0xabc", "n", "t", "l", "True", "", "", "", "", "2024-01-15"),
            ("3", "0x" + "AB" * 20, "n", "t", "l", "maybe", "", "", "", "", "2024-01-15"),
            ("4", "0x" + "ab" * 20, None, None, None, None, None, None, None, None, "15/01/2024"),
        ],
        ",".join(f"{f.name} string" for f in LABEL_TABLE_SCHEMA.fields),
    )
    good, rejects = tables.type_rows(text, LABEL_TABLE_SCHEMA)
    assert [r["no"] for r in good.collect()] == [1]
    reasons = sorted(r["reject_reason"] for r in rejects.collect())
    assert reasons == sorted([
        "no: not a int",
        "odd number of hex digits",
        "isuseraddress: not a boolean",
        "update_date: not a date",
    ])


def test_table_lifecycle_and_refresh(spark, tmp_dir):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("chain", T.StringType()), T.StructField("n", T.IntegerType())])
    ns = "wf_test_lifecycle"
    root = os.path.join(tmp_dir, "tbl")
    assert tables.create_table(spark, ns, "t", "desc", schema, root=root)
    assert tables.create_table(spark, ns, "t", "desc", schema, root=root)
    p1 = os.path.join(tmp_dir, "c1")
    write_csv(spark.createDataFrame([("a", 1), ("b", 2)], schema), p1)
    assert tables.load_csv(spark, p1, ns, "t", mode="append").rows_written == 2
    assert tables.load_csv(spark, p1, ns, "t", mode="append").rows_written == 2
    assert spark.table(f"{ns}.t").count() == 4
    p2 = os.path.join(tmp_dir, "c2")
    write_csv(spark.createDataFrame([("z", 9)], schema), p2)
    assert tables.load_csv(spark, p2, ns, "t", mode="refresh").rows_written == 1
    assert [tuple(r) for r in spark.table(f"{ns}.t").collect()] == [("z", 9)]
    assert tables.load_csv(spark, os.path.join(tmp_dir, "missing"), ns, "t").ok is False
    assert tables.clear_table(spark, ns, "t")
    assert spark.table(f"{ns}.t").count() == 0
    assert tables.delete_table(spark, ns, "t")
    assert not tables.delete_table(spark, ns, "t")
