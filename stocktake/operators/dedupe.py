"""De-duplication and insert-if-absent on natural keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .keys import dense_keys


def distinct_values(df: DataFrame, col: "str | Column", alias: str,
                    drop_null: bool = True) -> DataFrame:
    """``SELECT DISTINCT expr AS alias`` (optionally without NULL)."""
    expr = F.col(col) if isinstance(col, str) else col
    out = df.select(expr.alias(alias))
    if drop_null:
        out = out.where(F.col(alias).isNotNull())
    return out.distinct()


def distinct_items(df: DataFrame, items: Column, alias: str) -> DataFrame:
    """Distinct elements of an array column (NULL/empty arrays give no rows)."""
    return df.select(F.explode(items).alias(alias)).distinct()


def entity_from_columns(df: DataFrame, cols: list[str], alias: str = "name") -> DataFrame:
    """Merge the non-NULL values of several columns into one distinct entity
    list (e.g. developers and publishers into parties)."""
    items = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(alias))
    return items.where(F.col(alias).isNotNull()).distinct()


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """``SELECT DISTINCT a, b``."""
    return df.select(*cols).dropDuplicates(cols)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING`` as a pure function:
    existing rows plus incoming keys not yet present (each once)."""
    fresh = (incoming.select(key).where(F.col(key).isNotNull()).distinct()
             .join(existing.select(key), key, "left_anti"))
    return existing.select(key).unionByName(fresh)


def fresh_keys(existing: DataFrame, incoming: DataFrame, name_col: str,
               key_col: str) -> DataFrame:
    """Names of ``incoming`` not yet in ``existing``, keyed densely after the
    current maximum key (the rows an insert-if-absent would add)."""
    fresh = (incoming.select(name_col).where(F.col(name_col).isNotNull()).distinct()
             .join(existing.select(name_col), name_col, "left_anti"))
    top = existing.agg(F.max(key_col)).first()[0] or 0  # one scalar
    keyed = dense_keys(fresh, name_col, key_col)
    return keyed.select((F.col(key_col) + F.lit(top)).alias(key_col), F.col(name_col))


def append_with_keys(existing: DataFrame, incoming: DataFrame, name_col: str,
                     key_col: str) -> DataFrame:
    """Insert-if-absent for a keyed dimension: new names get dense keys after
    the current maximum, existing names keep theirs."""
    return existing.select(key_col, name_col).unionByName(
        fresh_keys(existing, incoming, name_col, key_col))
