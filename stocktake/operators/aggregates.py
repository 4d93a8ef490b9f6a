"""Grouped aggregation helpers.

Everything here keeps Spark's partial (map-side) aggregation: a hot group is
pre-combined in every map task before the shuffle, so its final task sees one
partial buffer per map task rather than its rows. The exact median is computed
from per-value frequencies and, by default, range-splits every group, so no
group is handled by a single task (see :func:`grouped_percentile`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpoint_dir


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def mean(col) -> Column:
    """Average that skips NULLs, as ``double``: exact sum / count.

    For decimals the sum is exact, so the only rounding is the final division;
    NULL when there are no values.
    """
    c = _c(col)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def at_least(df: DataFrame, count_col: str, minimum: int) -> DataFrame:
    """``HAVING COUNT(x) >= minimum`` on an aggregated frame."""
    return df.where(F.col(count_col) >= F.lit(minimum))


def grouped_percentile(df: DataFrame, keys: list[str], value: "str | Column",
                       fraction: float = 0.5, alias: str = "median",
                       count_alias: str | None = None, method: str = "split",
                       num_partitions: int | None = None) -> DataFrame:
    """Exact continuous percentile per group (``PERCENTILE_CONT``), NULLs skipped.

    Both methods start from ``(keys, value) -> frequency`` (partial
    aggregation, so a hot group is pre-combined map-side) and interpolate
    linearly between the values at the ranks around ``fraction * (n - 1)``.

    * ``method="split"`` (default): no group is ever handled by one task. The
      frequency rows are range-partitioned on ``(keys, value)`` and
      checkpointed, so a hot group spreads over several partitions ("chunks").
      Chunk totals (one row per group and partition) give each chunk's rank
      offset. Only the chunks that hold the two middle ranks are scanned
      again, with a running count inside each chunk.
    * ``method="window"``: one running count per group. This is cheaper (one
      exchange fewer, no checkpoint), but a group's distinct values meet in
      one task (sorted, spillable). Use it when the value domain is small,
      such as a rating scale.

    Groups whose values are all NULL do not appear. ``count_alias`` adds the
    number of non-NULL values per group (no extra pass).
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    v = _c(value).cast("double")
    freq = (df.where(v.isNotNull())
            .groupBy(*[F.col(k) for k in keys], v.alias("_v"))
            .agg(F.count(F.lit(1)).alias("_cnt")))
    if method == "window":
        ranked = _ranks_by_window(freq, keys, fraction)
    elif method == "split":
        ranked = _ranks_by_chunks(freq, keys, fraction, num_partitions)
    else:
        raise ValueError(f"unknown method {method!r}")
    out = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("_cum") > F.col("_lo"), F.col("_v"))).alias("_lo_v"),
        F.min(F.when(F.col("_cum") > F.col("_hi"), F.col("_v"))).alias("_hi_v"),
        F.max("_frac").alias("_f"),
        F.max("_tot").alias("_n"))
    result = F.col("_lo_v") + F.col("_f") * (F.col("_hi_v") - F.col("_lo_v"))
    cols = [F.col(k) for k in keys]
    if count_alias:
        cols.append(F.col("_n").alias(count_alias))
    cols.append(result.alias(alias))
    return out.select(*cols)


def _rank_bounds(df: DataFrame, fraction: float) -> DataFrame:
    pos = (F.col("_tot") - 1).cast("double") * F.lit(float(fraction))
    return (df.withColumn("_lo", F.floor(pos)).withColumn("_hi", F.ceil(pos))
            .withColumn("_frac", pos - F.floor(pos)))


def _ranks_by_window(freq: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """Running frequency per whole group (``_cum``), with the group total."""
    group = Window.partitionBy(*keys)
    running = group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    freq = (freq.withColumn("_cum", F.sum("_cnt").over(running))
                .withColumn("_tot", F.sum("_cnt").over(group)))
    return _rank_bounds(freq, fraction)


def _ranks_by_chunks(freq: DataFrame, keys: list[str], fraction: float,
                     num_partitions: int | None) -> DataFrame:
    """Running frequency computed chunk-wise, only for the chunks that matter.

    Chunk = the rows of one group inside one range partition. Its rank offset
    is the sum of earlier chunks of the group, taken from the chunk-total table
    (one row per group and partition; a group has at most ``num_partitions``
    chunks, so the window over it is bounded).
    """
    spark = freq.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (freq.repartitionByRange(n, *[F.col(k) for k in keys], F.col("_v"))
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    part = keys + ["_pid"]
    chunks = ranged.groupBy(*part).agg(F.sum("_cnt").alias("_ccnt"), F.min("_v").alias("_cmin"))
    earlier = Window.partitionBy(*keys).orderBy("_cmin").rowsBetween(
        Window.unboundedPreceding, -1)
    chunks = (chunks.withColumn("_before", F.coalesce(F.sum("_ccnt").over(earlier), F.lit(0)))
              .withColumn("_tot", F.sum("_ccnt").over(Window.partitionBy(*keys))))
    chunks = _rank_bounds(chunks, fraction)

    def holds(rank: str):
        return (F.col("_before") <= F.col(rank)) & (F.col(rank) < F.col("_before") + F.col("_ccnt"))

    tags = [f"_t{i}" for i in range(len(part))]
    targets = chunks.where(holds("_lo") | holds("_hi")).select(
        *[F.col(c).alias(t) for c, t in zip(part, tags)], "_before", "_tot", "_lo", "_hi", "_frac")
    # NULL is a group of its own, so the keys are matched null-safely.
    cond = [F.col(c).eqNullSafe(F.col(t)) for c, t in zip(part, tags)]
    rows = ranged.join(targets, cond).drop(*tags)
    within = Window.partitionBy(*part).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_cum", F.col("_before") + F.sum("_cnt").over(within))


def approx_percentile(value: "str | Column", fraction: float = 0.5,
                      accuracy: int = 10000) -> Column:
    """Opt-in approximate percentile (bounded memory per group); not equal to
    the exact result."""
    return F.percentile_approx(_c(value).cast("double"), fraction, accuracy)


def count_histogram(df: DataFrame, entity: str, item: str, count_alias: str) -> DataFrame:
    """First level of a two-level aggregation: ``COUNT(item)`` per entity."""
    return df.groupBy(entity).agg(F.count(F.col(item)).alias(count_alias))
