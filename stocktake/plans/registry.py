"""Registry of named check queries: a Spark builder plus (optionally) the
equivalent DuckDB SQL over the same Parquet tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# Check outputs with decimal columns, by scale. Both sides give them as text with
# all their digits, so neither rounding nor a declared scale can hide behind a float.
DECIMAL_SCALES = {
    "l7_pricing": {"base_amount": 18, "final_amount": 18, "amount": 18},
    "l8_rating": {"overall_avg_rating": 18, "filtered_avg_rating": 18},
    "l9_discount_status": {"discount_percentage": 18, "discount_difference": 18},
    "m6_type_contribution": {"total_base_amount_proxy": 18},
    "m7_content_groups": {"total_base_amount_value": 18},
    "c1_inner_star": {"quantity_sum": 2},
    "c5_left_enrich": {"returned_qty": 2},
    "c9_outer_to_inner": {"big_order_value": 2},
    "e3_sum_decimal": {"price_sum": 2},
    "e10_multi_agg": {"total_sum": 2},
    "f_order_nulls_first": {"returned_qty": 2},
    "h8_decimal_cast": {"price": 18},
    "h12_guarded_cast": {"discount_pct": 18},
}


def _as_text(df: DataFrame, scales: dict[str, int]) -> DataFrame:
    for name, scale in scales.items():
        if not df.schema[name].dataType.simpleString().endswith(f",{scale})"):
            raise TypeError(f"{name} is {df.schema[name].dataType}, not of scale {scale}")
    return df.select(*[F.replace(F.format_number(c, scales[c]), F.lit(","), F.lit("")).alias(c) if c in scales
                       else F.col(c) for c in df.columns])


def register(name: str, sql: str | None = None):
    """Decorator: record ``fn(spark, base_dir)`` under ``name`` with its SQL twin."""
    scales = DECIMAL_SCALES.get(name, {})

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        if scales:
            @functools.wraps(fn)
            def wrapped(spark: SparkSession, base_dir: str) -> DataFrame:
                return _as_text(fn(spark, base_dir), scales)
            QUERIES[name] = wrapped
        else:
            QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql if not scales else (
                "SELECT * REPLACE (" + ", ".join(
                    f"CAST(CAST({c} AS DECIMAL(38,{scale})) AS VARCHAR) AS {c}" for c, scale in scales.items())
                + f") FROM (\n{sql}\n) q")
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import catalog_queries, core_queries, text_queries  # noqa: F401
