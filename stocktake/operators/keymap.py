"""Persistent surrogate keys: a name that got a key keeps it, whoever comes later.

A key map is an append-only table of (key, name). A rebuild of the tables and a
stream both extend the same map: names that it holds keep their keys, new ones get
the numbers after the largest. So dense keys mean the same before and after, and
tables that were written at different times can be joined.

Layout: ``<path>/upto=<largest key>/bucket=<hash of name>``, one ``upto`` folder per
extension. The largest key so far is in the folder's name, so no data is read for it,
and only the buckets of the names at hand are read to see which of them are new.
Keys of an extension that was cut short stay unused, or belong to the names whose
files arrived; a rerun finds those. One writer at a time extends a map; the load
report's check for unique names and keys shows it if two did.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import hadoop_path
from .keys import dense_keys

BUCKETS = 64


class KeyMap:
    def __init__(self, spark: SparkSession, path: str, name_col: str, key_col: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.name_col, self.key_col = name_col, key_col

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.name_col), F.lit(self.buckets)).cast("int")

    def top(self) -> int:
        """The largest key given out, from folder names alone."""
        files, at = hadoop_path(self.spark, self.path)
        if not files.exists(at):
            return 0
        found = (re.fullmatch(r"upto=(\d+)", f.getPath().getName()) for f in files.listStatus(at))
        return max((int(m[1]) for m in found if m), default=0)

    def stored(self, buckets: list[int] | None = None) -> DataFrame:
        """All of the map, or the names of some buckets."""
        kind = f"{self.key_col} bigint, {self.name_col} string"
        if not self.top():
            return self.spark.createDataFrame([], kind)
        rows = self.spark.read.schema(f"{kind}, upto bigint, bucket int").parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        return rows.select(self.key_col, self.name_col)

    def extend(self, names: DataFrame) -> int:
        """Give keys to the ``names`` (column ``name_col``) that have none; returns how many did not."""
        names = names.select(self.name_col).where(F.col(self.name_col).isNotNull()).distinct()
        touched = [r[0] for r in names.select(self._bucket().alias("b")).distinct().collect()]  # at most ``buckets``
        if not touched:
            return 0
        fresh = names.join(self.stored(touched).select(self.name_col), self.name_col, "left_anti")
        keyed = dense_keys(fresh, self.name_col, self.key_col)
        n = keyed.agg(F.max(self.key_col)).first()[0] or 0
        if n:
            top = self.top()
            (keyed.select((F.col(self.key_col) + top).alias(self.key_col), self.name_col, self._bucket().alias("bucket"))
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/upto={top + n}"))
        return n

    def keyed(self, names: DataFrame) -> DataFrame:
        """(key, name) of distinct ``names``, extending the map by those it lacks."""
        self.extend(names)
        return self.stored().join(names.select(self.name_col), self.name_col, "left_semi").select(self.key_col, self.name_col)
