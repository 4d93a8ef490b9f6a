"""Literal dimensions (``INSERT ... VALUES``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.tiers import PRODUCT_TYPES
from ..operators.joins import static_table
from ..schemas import TABLE_SCHEMAS


def product_type(spark: SparkSession) -> DataFrame:
    """The fixed product-type dimension (broadcast: its size is set by the code)."""
    return static_table(spark, list(PRODUCT_TYPES), TABLE_SCHEMAS["product_type"])
