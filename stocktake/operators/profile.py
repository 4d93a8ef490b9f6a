"""Column profiles of a load: exact counts and mergeable sketches, in one pass.

A profile has a row per column (and per group, such as a file or a load date). Its
counts, lengths and extremes are exact; the number of distinct values and the
quantiles of numeric text come from HLL and KLL sketches. Sketches are kept beside the
counts, so profiles of parts, or of one load after the other, merge into that of
the whole without reading the rows again. A sketch has a bounded size, whatever the
column holds, and is built per task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean

EXACT = ("rows", "nulls", "blanks", "min_length", "max_length", "smallest", "largest", "numbers")
QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
#: log2 of the registers of a distinct count: a standard error of some 1.6 %.
HLL_BITS = 12
#: Size parameter of a quantile sketch: ranks are right to some 1.3 %.
KLL_SIZE = 200


def _summary(column: str) -> Column:
    text = F.col(column).cast("string")
    number = F.when(clean.is_number(text), text).try_cast("double")
    return F.struct(
        F.lit(column).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count(F.when(text.isNull(), 1)).alias("nulls"),
        F.count(F.when(F.trim(text) == "", 1)).alias("blanks"), F.min(F.length(text)).cast("long").alias("min_length"),
        F.max(F.length(text)).cast("long").alias("max_length"), F.min(text).alias("smallest"), F.max(text).alias("largest"),
        F.count(number).alias("numbers"), F.hll_sketch_agg(text, HLL_BITS).alias("distinct_sketch"),
        F.kll_sketch_agg_double(number, KLL_SIZE).alias("number_sketch"))


def column_profile(df: DataFrame, columns: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """A row per group of ``by`` and column: the exact measures and both sketches. One pass over ``df``."""
    columns = [c for c in (columns or df.columns) if c not in by]
    rows = F.array(*[_summary(c) for c in columns]).alias("profile")
    return df.groupBy(*by).agg(rows).select(*by, F.inline("profile"))


def merge_profiles(profiles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Profiles of parts as those of the groups of ``by``; without it, of the whole."""
    sums = [F.sum(c).alias(c) for c in ("rows", "nulls", "blanks", "numbers")]
    ends = [F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
            F.min("smallest").alias("smallest"), F.max("largest").alias("largest")]
    merged = profiles.groupBy(*by, "column_name").agg(
        *sums, *ends, F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("number_sketch", KLL_SIZE).alias("number_sketch"))
    return merged.select(*by, "column_name", *EXACT, "distinct_sketch", "number_sketch")


def read_profile(profiles: DataFrame) -> DataFrame:
    """Profiles with the sketches' answers in place of the sketches: distinct values and quantiles of the numbers."""
    at = F.array(*[F.lit(q) for q in QUANTILES])
    return (profiles.withColumn("distinct_values", F.hll_sketch_estimate("distinct_sketch"))
            .withColumn("quantiles", F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("number_sketch", at)))
            .drop("distinct_sketch", "number_sketch"))
