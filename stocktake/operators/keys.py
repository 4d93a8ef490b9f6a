"""Surrogate keys for dimension names.

``dense_keys`` numbers the distinct names 1..N in binary name order without
ever funnelling the names through one task:

1. ``distinct`` (partial aggregation map-side, one hash exchange);
2. range-partition the *distinct* names and sort inside each partition;
3. checkpoint to the shared folder, which pins the range boundaries and the
   row order, so every later read (and any re-execution after an executor
   loss) sees the same layout;
4. position inside the partition from ``monotonically_increasing_id`` (its
   low 33 bits are the row number within the partition);
5. per-partition row counts (one small row per partition, the
   same step ``RDD.zipWithIndex`` runs) give each partition's key offset; the
   offsets go back into the plan as a literal array indexed by partition.

``hash_keys`` is the lookup-free alternative (stable across runs, not dense).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from ..session import checkpoint_dir

_ROW_BITS = 33


def dense_keys(df: DataFrame, name_col: str, key_col: str,
               num_partitions: int | None = None) -> DataFrame:
    """Return ``(key_col, name_col)`` with one dense key per distinct non-NULL name."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = df.select(F.col(name_col)).where(F.col(name_col).isNotNull()).distinct()
    ranged = (names.repartitionByRange(num_partitions, F.col(name_col))
              .sortWithinPartitions(name_col)
              .checkpoint(eager=True))
    pid = F.spark_partition_id()
    stats = (ranged.groupBy(pid.alias("_pid"))
             .agg(F.count(F.lit(1)).alias("_n"))
             .collect())  # one row per partition
    # Empty partitions are absent from the stats and hold no rows to key.
    n_parts = max([row["_pid"] for row in stats], default=0) + 1
    counts = [0] * n_parts
    for row in stats:
        counts[row["_pid"]] = row["_n"]
    offsets = [0] + list(accumulate(counts))[:-1]
    # One array literal (a single plan node, even for many thousand partitions).
    offset = F.element_at(F.lit(offsets).cast("array<bigint>"), pid + 1)
    position = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), _ROW_BITS)
    keyed = ranged.select((offset + position + F.lit(1)).cast("long").alias(key_col),
                          F.col(name_col))
    return keyed


def hash_keys(df: DataFrame, name_col: str, key_col: str) -> DataFrame:
    """One 64-bit hash key per distinct non-NULL name (check collisions with
    :func:`stocktake.operators.quality.duplicate_keys` on the key)."""
    return (df.select(F.col(name_col)).where(F.col(name_col).isNotNull()).distinct()
            .select(F.xxhash64(F.col(name_col)).alias(key_col), F.col(name_col)))
