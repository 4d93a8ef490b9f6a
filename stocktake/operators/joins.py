"""Join helpers: key lookups, role-playing dimensions, restriction, skeletons.

Physical strategy is left to Catalyst + AQE: a dimension becomes a broadcast
only after its shuffle output is measured below
``spark.sql.autoBroadcastJoinThreshold``, otherwise it is a sort-merge join
whose skewed partitions AQE splits. ``broadcast`` is forced only on
literal-sized inputs (static dimensions, category skeletons).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def lookup_key(df: DataFrame, dim: DataFrame, on: "str | Column", dim_name: str,
               dim_key: str, alias: str, how: str = "left") -> DataFrame:
    """Attach ``dim_key`` as ``alias`` where ``on`` equals ``dim_name``.

    Calling it twice with different ``on``/``alias`` is a role-playing join of
    the same dimension (e.g. publisher and developer both looked up in party).
    """
    probe = F.col(on) if isinstance(on, str) else on
    tag = f"_lk_{alias}"
    right = dim.select(F.col(dim_name).alias(tag), F.col(dim_key).alias(alias))
    return df.join(right, probe == F.col(tag), how).drop(tag)


#: A value that more than one in so many rows have is frequent; there are fewer frequent values than this.
FREQUENT_SHARE = 1000
#: Values that the sketch tracks: it misjudges a count by less than a fifth of a frequent value's.
TRACKED_VALUES = 8192


def frequent_values(df: DataFrame, col: "str | Column", share: int = FREQUENT_SHARE) -> list:
    """Non-NULL values that more than a ``share``-th of the rows with one have.

    One pass with a frequent-items sketch, built per task and merged, so the work
    and the result (at most ``share`` values) are bounded whatever the data. None
    is missed; a value a little below the share may be among them.
    """
    value = F.col(col) if isinstance(col, str) else col
    found = df.select(value.alias("v")).where(F.col("v").isNotNull()).agg(
        F.expr(f"approx_top_k(v, {share}, {TRACKED_VALUES})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] * share > found["n"]]


#: A dimension of at most so many rows, which is counted first, is broadcast whole.
SMALL_DIMENSION = 10_000


def spread_lookup(df: DataFrame, dim: DataFrame, on: "str | Column", dim_name: str, dim_key: str, alias: str,
                  how: str = "left", look_in: DataFrame | None = None) -> DataFrame:
    """:func:`lookup_key` for facts of which a third may share a name, or have none.

    A small dimension is joined in place. Beside a larger one, rows without a name
    and rows of the few frequent names get their key where they are, and only the
    others are shuffled to the dimension, whose names are unique. So no task meets
    more than its share of rows, without relying on skew being noticed at run time.

    Starts a job that counts up to ``SMALL_DIMENSION`` rows, and if there are more,
    one that finds the frequent names in ``look_in`` (by default ``df``; give what is
    cheaper to read and has the same names).
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    if dim.limit(SMALL_DIMENSION + 1).count() <= SMALL_DIMENSION:
        return lookup_key(df, F.broadcast(dim), on, dim_name, dim_key, alias, how)
    probe = F.col(on) if isinstance(on, str) else on
    names = frequent_values(df if look_in is None else look_in, probe)
    here = probe.isin(names) if names else F.lit(False)
    few = F.broadcast(dim.where(F.col(dim_name).isin(names)) if names else dim.limit(0))  # names are unique
    bypass = df.where(probe.isNull() | here) if how == "left" else df.where(here)
    rest = df.where(probe.isNotNull() & ~here)
    return (lookup_key(bypass, few, on, dim_name, dim_key, alias, how)
            .unionByName(lookup_key(rest, dim, on, dim_name, dim_key, alias, how)))


def restrict_to(df: DataFrame, keys: DataFrame, df_col: str, key_col: str) -> DataFrame:
    """``WHERE df_col IN (SELECT key_col FROM keys)`` as a left-semi join."""
    right = keys.select(F.col(key_col).alias("_rk"))
    return df.join(right, F.col(df_col) == F.col("_rk"), "left_semi")


def exclude(df: DataFrame, keys: DataFrame, df_col: str, key_col: str) -> DataFrame:
    """Rows whose ``df_col`` matches no ``key_col`` (left-anti join)."""
    right = keys.select(F.col(key_col).alias("_rk"))
    return df.join(right, F.col(df_col) == F.col("_rk"), "left_anti")


#: 64-bit words of the bitmap by which :func:`sift` sorts rows out: a table of at most so many rows.
SIFT_WORDS = 1 << 17


def sift(df: DataFrame, col: str, keys: DataFrame, key_col: str) -> DataFrame:
    """Rows whose ``col`` may be among ``keys``, sorted out where they are.

    The bitmap of the keys' hashes has a fixed size, so it is broadcast whatever
    the number of keys. No row that matches is lost; of those that do not, the
    share that stays is that of the bits set: one in 8,000 for a thousand keys.
    Follow it with an exact join, which then shuffles little.
    """
    place = lambda c: F.pmod(F.xxhash64(c.cast("string")), F.lit(64 * SIFT_WORDS))
    held = (keys.select(place(F.col(key_col)).alias("_p")).groupBy(F.shiftright("_p", 6).alias("_held"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(_p % 64 AS int))")).alias("_mask")))
    marked = df.withColumn("_word", F.shiftright(place(F.col(col)), 6)).withColumn("_bit", (place(F.col(col)) % 64).cast("int"))
    return marked.join(F.broadcast(held), (F.col("_word") == F.col("_held")) & (F.getbit("_mask", "_bit") == 1),
                       "left_semi").drop("_word", "_bit")


def static_table(spark: SparkSession, rows: list[tuple], schema: "T.StructType | str") -> DataFrame:
    """A literal table (``VALUES``); size is fixed by the code, so broadcasting it is safe."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def with_required_categories(spark: SparkSession, categories: list[str], label: str,
                             aggregated: DataFrame, agg_label: str,
                             zero_fill: list[str] = ()) -> DataFrame:
    """Completeness skeleton: every required category appears once, joined to
    the aggregate; counts in ``zero_fill`` become 0 where the category had no
    rows, the other metrics stay NULL. Categories that the list lacks are kept."""
    skeleton = static_table(spark, [(c,) for c in categories],
                            T.StructType([T.StructField(label, T.StringType(), False)]))
    joined = skeleton.join(aggregated, skeleton[label] == aggregated[agg_label], "full")
    cols = [F.coalesce(skeleton[label], aggregated[agg_label]).alias(label)]
    for name in aggregated.columns:
        if name == agg_label:
            continue
        c = aggregated[name]
        cols.append(F.coalesce(c, F.lit(0)).cast(aggregated.schema[name].dataType).alias(name)
                    if name in zero_fill else c.alias(name))
    return joined.select(*cols)
