"""Parquet table access.

Reads are lazy; Catalyst prunes columns and pushes filters into the Parquet
scan (``ReadSchema`` / ``PushedFilters`` in ``explain``), so callers select
what they need and never pre-load whole tables.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One Parquet table (a file or a folder of part files) under ``base_dir``."""
    return spark.read.parquet(table_path(base_dir, name))


def read_tables(spark: SparkSession, base_dir: str, names) -> dict[str, DataFrame]:
    return {n: read_table(spark, base_dir, n) for n in names}


def write_tables(tables: dict[str, DataFrame], base_dir: str, mode: str = "overwrite",
                 parallelism: int = 4) -> None:
    """Write each table to ``base_dir/<name>.parquet`` (idempotent overwrite).

    Independent tables are written by concurrent jobs so small tables do not
    leave the cluster idle while a large one finishes.
    """
    def write(item):
        name, df = item
        df.write.mode(mode).parquet(table_path(base_dir, name))

    if parallelism <= 1:
        for item in tables.items():
            write(item)
        return
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(write, tables.items()))


# Tables keyed by title. Saved bucketed on ``title_id`` with one common bucket
# count, the title-level joins of the reports (inventory x rating x pricing,
# bridges x inventory) read co-partitioned buckets and need no shuffle.
TITLE_BUCKETED = ("inventory", "pricing", "rating", "discount_status", "title_genre",
                  "title_os")


def save_tables(tables: dict[str, DataFrame], database: str, num_buckets: int,
                bucket_key: str = "title_id", bucketed=TITLE_BUCKETED,
                parallelism: int = 4, suffix: str = "") -> None:
    """Save tables to the session catalog (``database.name`` and the suffix); the
    title-keyed ones bucketed and sorted on ``bucket_key``.

    Size ``num_buckets`` so that one bucket of the largest table is a few
    hundred MB; every title-keyed table must use the same count.
    """
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def save(item):
        name, df = item
        writer = df.write.mode("overwrite").format("parquet")
        if name in bucketed:
            writer = writer.bucketBy(num_buckets, bucket_key).sortBy(bucket_key)
        writer.saveAsTable(f"{database}.{name}{suffix}")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(save, tables.items()))


def load_saved_tables(spark: SparkSession, database: str, names, suffix: str = "") -> dict[str, DataFrame]:
    return {n: spark.table(f"{database}.{n}{suffix}") for n in names}
