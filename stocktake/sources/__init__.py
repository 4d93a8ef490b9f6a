"""Sources and sinks: Parquet tables, CSV staging, literal dimensions."""

from . import csv_stage, static, tables  # noqa: F401
