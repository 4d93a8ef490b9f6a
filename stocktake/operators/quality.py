"""Data-quality jobs: key uniqueness, not-null, referential integrity, load report.

The source relies on constraints enforced at insert; here they are checks run
after a load, each a distributed aggregate or anti-join that returns a small
DataFrame (never the checked table itself).
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .. import schemas
from ..functions import clean
from .joins import restrict_to, sift


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: number of NULLs per column, all counted in a single pass."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])


def orphan_keys(child: DataFrame, refs: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """ref (position in ``refs``), key and occurrences of references without a parent.

    ``refs`` holds (child column, parent, parent column). All columns are counted
    in one pass over the child, before any join, so that the shuffle moves one row
    per task and key, however often a key occurs; NULL references, which are
    allowed, never move. What is joined are the parents' keys.
    """
    kinds = [child.schema[fk].dataType for fk, _, _ in refs]
    integral = all(k.simpleString() in ("tinyint", "smallint", "int", "bigint") for k in kinds)
    kind = "bigint" if integral else "string"
    pairs = [F.struct(F.lit(i).alias("ref"), F.col(fk).cast(kind).alias("key")) for i, (fk, _, _) in enumerate(refs)]
    stacked = child.select(F.explode(F.array(*pairs)).alias("r")).select("r.*") if len(pairs) > 1 else child.select(
        F.lit(0).alias("ref"), F.col(refs[0][0]).cast(kind).alias("key"))
    counted = stacked.where(F.col("key").isNotNull()).groupBy("ref", "key").agg(F.count(F.lit(1)).alias("occurrences"))
    known = reduce(DataFrame.unionByName, [
        parent.select(F.lit(i).alias("ref"), F.col(pk).cast(kind).alias("key"))
        for i, (_, parent, pk) in enumerate(refs)])
    return counted.join(known, ["ref", "key"], "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no parent (NULL references are allowed).

    The keys without a parent are found first; a bitmap of them sorts out the
    other rows in place, so only rows of missing keys are shuffled.
    """
    missing = orphan_keys(child, [(fk, parent, pk)]).select(F.col("key").cast(child.schema[fk].dataType).alias("key"))
    return restrict_to(sift(child, fk, missing, "key"), missing, fk, "key")


def _key_metrics(name: str, df: DataFrame, keys: list[str], required: list[str], rows: bool) -> DataFrame:
    """One grouped pass over a key: rows that share it and, with ``rows``, the
    row count and the NULLs in required columns."""
    nulls = reduce(lambda a, b: a + b, [F.when(F.col(c).isNull(), 1).otherwise(0) for c in required], F.lit(0))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("nulls"))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    return per_key.agg(
        F.sum("n" if rows else F.lit(0)).alias("row_count"),
        F.sum(F.when((F.col("n") > 1) & known, F.col("n"))).alias("duplicate_key_rows"),
        F.sum("nulls" if rows else F.lit(0)).alias("null_violations"),
        F.lit(0).alias("orphan_rows")).select(F.lit(name).alias("table_name"), "*")


def _reference_metrics(name: str, df: DataFrame, refs: list, tables: dict[str, DataFrame]) -> DataFrame:
    """One pass over a child: rows whose non-NULL references lack their parent."""
    missing = orphan_keys(df, [(fk, tables[parent], pk) for _, fk, parent, pk in refs])
    return missing.agg(F.lit(0).alias("row_count"), F.lit(0).alias("duplicate_key_rows"), F.lit(0).alias("null_violations"),
                       F.sum("occurrences").alias("orphan_rows")).select(F.lit(name).alias("table_name"), "*")


def _table_metrics(name: str, df: DataFrame, tables: dict[str, DataFrame],
                   primary: dict, unique: dict, not_null: dict, refs: list) -> list[DataFrame]:
    """One-row metric frames for one table: a pass per key, and one for all references."""
    keys = primary.get(name) or unique.get(name) or list(df.columns)
    required = list(dict.fromkeys(not_null.get(name, []) + primary.get(name, [])))
    out = [_key_metrics(name, df, keys, required, True)]
    if name in unique and unique[name] != keys:
        out.append(_key_metrics(name, df, unique[name], [], False))
    own = [r for r in refs if r[0] == name and r[2] in tables]
    return out + ([_reference_metrics(name, df, own, tables)] if own else [])


def load_report(tables: dict[str, DataFrame], primary: dict | None = None,
                unique: dict | None = None, not_null: dict | None = None,
                refs: list | None = None) -> DataFrame:
    """One row per table: rows, rows sharing a primary/unique key, NULLs in
    required columns, and child rows with a dangling reference."""
    primary = schemas.PRIMARY_KEYS if primary is None else primary
    unique = schemas.UNIQUE_KEYS if unique is None else unique
    not_null = schemas.NOT_NULL if not_null is None else not_null
    refs = schemas.FOREIGN_KEYS if refs is None else refs
    parts = [m for name, df in tables.items()
             for m in _table_metrics(name, df, tables, primary, unique, not_null, refs)]
    metrics = reduce(DataFrame.unionByName, parts)
    return metrics.groupBy("table_name").agg(*[
        F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m)
        for m in ("row_count", "duplicate_key_rows", "null_violations", "orphan_rows")])


CONVERSION_METRICS = ("lost_digits", "rejected", "null_items")


def conversion_counts(text, kind: str, only: Column | None = None) -> dict[str, Column]:
    """Aggregates over text that is converted: amounts whose digits exceed the decimal (they are kept
    as text), text that is rejected, and NULL items that a list drops."""
    c = F.col(text) if isinstance(text, str) else text
    c = c if only is None else F.when(only, c)
    dropped = F.lit(None).cast("int")
    if kind == "list":
        items = clean.json_list_items(c, strict=False)
        dropped = F.size(items) - F.size(F.array_compact(items))
    return {"lost_digits": F.count(F.when(clean.loses_digits(c), 1)) if kind == "amount" else F.count(F.lit(None)),
            "rejected": F.count(F.when(clean.rejected(c, kind), 1)),
            "null_items": F.coalesce(F.sum(F.when(dropped > 0, dropped)), F.lit(0)).cast("long")}


def conversion_report(df: DataFrame, amounts: list[str] = (), lists: list[str] = ()) -> DataFrame:
    """One row per text column with its :func:`conversion_counts`, in one pass over ``df``."""
    kinds = {**dict.fromkeys(amounts, "amount"), **dict.fromkeys(lists, "list")}
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *(v.cast("long").alias(n) for n, v in conversion_counts(c, kind).items()))
                     for c, kind in kinds.items()])
    return df.agg(rows.alias("r")).select(F.inline("r"))


class ObservedConversions:
    """The counts of :func:`conversion_report`, taken while some other job reads or writes the rows.

    ``columns`` gives the kind of each text column, ``text`` the text that its
    conversion meets; rows outside ``only`` do not count.
    """

    def __init__(self, columns: dict[str, str], text=F.col, only: Column | None = None):
        self.columns = list(columns)
        self._observed = Observation(f"conversions-{os.urandom(4).hex()}")
        self._counts = [v.alias(f"{c}|{n}") for c, kind in columns.items()
                        for n, v in conversion_counts(text(c), kind, only).items()]

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, whose next job counts."""
        return df.observe(self._observed, *self._counts)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per column, once that job is done."""
        got = self._observed.get
        return spark.createDataFrame([(c, *(got[f"{c}|{n}"] for n in CONVERSION_METRICS)) for c in self.columns],
                                     "column_name string, " + ", ".join(f"{n} long" for n in CONVERSION_METRICS))

    def total(self, metric: str) -> int:
        return sum(v for k, v in self._observed.get.items() if k.endswith(f"|{metric}"))


def assert_clean(report: DataFrame) -> None:
    """Fail the job when any table has a key, NULL or reference violation."""
    bad = report.where((F.col("duplicate_key_rows") > 0) | (F.col("null_violations") > 0)
                       | (F.col("orphan_rows") > 0))
    rows = bad.collect()  # one row per table at most
    if rows:
        raise ValueError(f"data-quality violations: {[r.asDict() for r in rows]}")
