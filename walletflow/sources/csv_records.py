"""S6 for files of any size: quoted CSV read in as many tasks as the file has splits.

A line break belongs to a cell exactly where the number of quotes before it is odd
(a doubled quote counts twice).  So

1. the text reader cuts the files into lines, split by split; each line's quotes are
   counted where it is read;
2. quotes are summed per split, and a window over a file's splits (one row each) gives
   the parity at every split's start and the record that is still open there;
3. inside a split a running sum gives the parity at every line, hence the lines that
   start a record; lines of one record that are spread over lines or splits are put
   together again, all others are records as they are;
4. ``from_csv`` parses the records.

Where no line has an odd number of quotes there is nothing to put together and step 2
and 3, with their shuffle, are left out.  Records end with \\n or \\r\\n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PARSE_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true", "header": "false",
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line, quotes): lines of all files; ``at`` orders the lines of a block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long").alias("quotes"),
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, header): the text of every record, and whether it is its file's first."""
    lines = csv_lines(spark, path)
    firsts = lines.where("block = 0").groupBy("file").agg(F.min("at").alias("at"), F.lit(True).alias("header"))  # a row per file
    lines = lines.join(firsts, ["file", "at"], "left").withColumn("header", F.coalesce("header", F.lit(False)))
    if lines.where("quotes % 2 = 1").isEmpty():
        records = lines.select(F.col("line").alias("record"), "header")
    else:
        records = _joined(lines)
    ended = F.regexp_replace("record", "\r$", "")  # of \r\n
    return records.select(ended.alias("record"), "header").where("record <> ''")


def _joined(lines: DataFrame) -> DataFrame:
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"))
    blocks = odd.select("file", "block", F.coalesce(F.sum("odd").over(earlier) % 2, F.lit(0)).alias("open"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    so_far = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = lines.join(blocks, ["file", "block"]).withColumn("starts", (F.col("open") + so_far) % 2 == 0)
    # the number of a line's record in its block; 0: the record began in an earlier block
    numbered = starts.withColumn("number", F.sum(F.col("starts").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    alone = F.col("starts") & (F.col("quotes") % 2 == 0)
    parts = numbered.where(~alone)
    # the last record of the nearest earlier block in which one starts
    last = numbered.groupBy("file", "block").agg(F.max("number").alias("number"))
    owners = last.select("file", "block", F.last(F.when(F.col("number") > 0, F.struct("block", "number")), ignorenulls=True).over(earlier).alias("owner"))
    own = F.struct("block", "number")
    spread = parts.where("number = 0").join(owners, ["file", "block"]).unionByName(parts.where("number > 0").withColumn("owner", own))
    whole = spread.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("parts"), F.max("header").alias("header"))
    return numbered.where(alone).select(F.col("line").alias("record"), "header").unionByName(
        whole.select(F.array_join(F.col("parts.line"), "\n").alias("record"), "header")
    )


def read_csv_splits(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of quoted CSV files with a header, all columns as text, NULL for an empty cell.  A header
    that differs from ``columns``, or a record with another number of cells, fails the read."""
    cells = csv_records(spark, path).select(F.from_csv("record", _ddl(columns), PARSE_OPTIONS).alias("cells"), "header")
    named = F.array(*[F.col("cells")[c] for c in columns]) == F.array(*[F.lit(c) for c in columns])
    told = F.when(~F.col("header"), F.lit(True)).when(named, F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit("the header differs from the columns: "), F.to_json("cells"))).cast("boolean")
    )
    return cells.where(told).select(*[F.col("cells")[c].alias(c) for c in columns])


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
