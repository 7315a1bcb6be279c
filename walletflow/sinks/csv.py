"""CSV in the dialect of Python's default ``csv`` writer.

Minimal quoting with doubled quotes, empty string written as an empty
cell, spaces kept, ``True``/``False`` for booleans.  Newlines inside cells
are kept and read back with ``multiLine``.  Empty and NULL cannot be told
apart after the round trip (both are an empty cell).  Output is a
directory of part files written in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletflow.functions.text import bool_text
from walletflow.schemas import text_schema

WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
    "maxRecordsPerFile": "1000000",  # a file is read by one task
}

READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "enforceSchema": "false",  # a header that differs from the columns fails the read
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def as_csv_text(df: DataFrame) -> DataFrame:
    """Every column as the text the reference writes."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = bool_text(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.BinaryType):
            c = F.concat(F.lit("0x"), F.lower(F.hex(c)))
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write ``df`` as CSV part files; returns the number of rows written
    (observed during the write, no second pass)."""
    obs = Observation("csv_rows")
    as_csv_text(df).observe(obs, F.count(F.lit(1)).alias("rows")).write.options(**WRITE_OPTIONS).mode(mode).csv(path)
    return int(obs.get.get("rows", 0) or 0)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read CSV text with a fixed all-string schema; a malformed file fails."""
    return spark.read.schema(text_schema(columns)).options(**READ_OPTIONS).csv(path)


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of each data file under a path, from file-system metadata
    (no data is read; hidden and ``_`` files are skipped)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        raise FileNotFoundError(path)
    sizes = []
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith((".", "_")):
            sizes.append(int(st.getLen()))
    return sizes


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes of all data files under a path."""
    return sum(file_sizes(spark, path))
