"""Text expressions used by the writers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bool_text(b: Column) -> Column:
    """Python's text of a bool: 'True' / 'False'; NULL stays NULL."""
    return F.when(b, F.lit("True")).when(~b, F.lit("False"))


def ensure_csv_suffix(name: Column) -> Column:
    return F.when(name.endswith(".csv"), name).otherwise(F.concat(name, F.lit(".csv")))


def default_file_name(prefix: str, ts: Column) -> Column:
    """'<prefix>yyyyMMdd_HHmmss.csv' for a run timestamp."""
    return F.concat(F.lit(prefix), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit(".csv"))


def megabytes(nbytes: Column) -> Column:
    """Bytes -> MB rounded to 2 decimals, as decimal so it prints exactly."""
    return F.round(nbytes.cast("decimal(38,6)") / F.lit(1048576), 2).cast("decimal(20,2)")


def default_file_name_text(prefix: str, when=None) -> str:
    """Driver-side twin of ``default_file_name`` for output paths."""
    import datetime as dt

    when = when or dt.datetime.now()
    return f"{prefix}{when.strftime('%Y%m%d_%H%M%S')}.csv"


def with_csv_suffix(name: str) -> str:
    return name if name.endswith(".csv") else name + ".csv"
