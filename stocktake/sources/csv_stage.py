"""CSV staging: read a positional, header-led CSV under a declared schema.

Options mirror a database bulk copy: the header row is skipped and columns
map by position (``enforceSchema``), ``""`` inside a quoted field is an escaped
quote, quoted fields may hold newlines, an unquoted empty field is NULL while
``""`` is the empty string, padding is kept, and a malformed row fails the load.

Convert to Parquet right away: later reads then prune to the few columns they use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import RAW_SCHEMA

READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    # The parser hands back ``nullValue`` for an unquoted empty field and
    # ``emptyValue`` for ``""``; a NUL sentinel keeps the two apart (with
    # ``nullValue=""`` both would read as NULL).
    "nullValue": "\u0000",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, *,
             multiline: bool) -> DataFrame:
    """Read CSV file(s) at ``path`` into ``schema`` (never inferred).

    The caller states whether quoted fields may hold newlines. With
    ``multiline`` each file is one task, so a large listing should be many
    files of moderate size; without it files are split, and a newline within
    quotes leaves rows of the wrong width, which fail the load.
    """
    opts = dict(READ_OPTIONS, multiLine="true" if multiline else "false")
    return spark.read.options(**opts).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write CSV that :func:`read_csv` reads back unchanged (NULL vs ``''`` kept)."""
    df.write.mode(mode).options(**WRITE_OPTIONS).csv(path)


def stage_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str,
                     schema: T.StructType = RAW_SCHEMA, *, multiline: bool,
                     watch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Bronze step: CSV -> Parquet once; returns the Parquet-backed frame.

    ``watch`` may attach counters to the rows, taken by this one pass.
    """
    rows = read_csv(spark, csv_path, schema, multiline=multiline)
    (watch(rows) if watch else rows).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)
