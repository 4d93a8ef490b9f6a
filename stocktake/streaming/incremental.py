"""Incremental staging of new listing files with Structured Streaming.

The source loads its dimensions with insert-if-absent semantics (``ON CONFLICT
DO NOTHING``): names already present keep their key, new names are added. As
a stream, every micro-batch of newly arrived CSV files is

1. written to the Parquet staging (bronze) table as its own ``epoch=<id>``
   partition (overwritten if the batch is replayed), and
2. merged into each keyed dimension table: names that have no key yet get one, and
   are appended. Dense keys live in a key map (:mod:`stocktake.operators.keymap`),
   of which a batch reads the buckets of its names. A rebuild given the same
   folder (``normalize(..., key_maps=tables_dir)``) extends the same maps, so keys
   mean the same in both.

Both steps are idempotent: a re-run of the same batch rewrites its own
staging partition, and finds its names already stored and appends nothing,
so a retried micro-batch (after an executor or driver loss) creates neither
duplicate rows nor duplicate names. The stream's own checkpoint lives
under the shared ``spark.checkpoint.dir``.

:func:`start_dimension_streams` does the second step as streams of their own over
the staged rows. Names that a stream has met are in its state store, so a batch
without new names reads nothing of a dimension, however large that is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.normalize import DIMENSION_SPECS, key_map, name_key
from ..schemas import RAW_SCHEMA, TABLE_SCHEMAS
from ..session import checkpoint_dir, path_exists
from ..sources.csv_stage import READ_OPTIONS
from ..sources.tables import table_path


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], TABLE_SCHEMAS[name])  # first batch: nothing stored yet


def merge_dimensions(batch: DataFrame, tables_dir: str,
                     dimensions: tuple[str, ...] = tuple(DIMENSION_SPECS),
                     keys: str = "dense") -> None:
    """Insert-if-absent of one batch's names into the stored dimension tables.

    ``keys="dense"`` extends the dimension's key map;
    ``keys="hash"`` keys them by ``xxhash64(name)``, which needs no maximum.
    """
    spark = batch.sparkSession
    for name in dimensions:
        names, name_col, key_col = DIMENSION_SPECS[name]
        if keys == "hash":
            path = table_path(tables_dir, name)
            existing = _stored(spark, path, name)
            fresh = (names(batch).join(existing.select(name_col), name_col, "left_anti")
                     .select(name_key(name_col).alias(key_col), F.col(name_col)))
            fresh.select(key_col, name_col).write.mode("append").parquet(path)
        else:
            key_map(spark, tables_dir, name).extend(names(batch))


def process_batch(batch: DataFrame, epoch_id: int, tables_dir: str,
                  keys: str | None = "dense") -> None:
    """Stage one micro-batch and, unless ``keys`` is None, merge its dimension names (idempotent)."""
    bronze = table_path(tables_dir, "raw")
    batch = batch.persist()
    try:
        # One folder per micro-batch, overwritten on replay: a batch re-run
        # after a failure replaces its own rows instead of adding them again.
        batch.write.mode("overwrite").parquet(f"{bronze}/epoch={epoch_id}")
        if keys is not None:
            merge_dimensions(batch, tables_dir, keys=keys)
    finally:
        batch.unpersist()


def start_listing_stream(spark: SparkSession, source_dir: str, tables_dir: str,
                         name: str = "listing", available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         keys: str | None = "dense") -> StreamingQuery:
    """Watch ``source_dir`` for listing CSV files; stage each batch and merge its names.

    ``keys=None`` only stages, for :func:`start_dimension_streams` to go on from.
    """
    reader = spark.readStream.schema(RAW_SCHEMA).options(**READ_OPTIONS, multiLine="true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.csv(source_dir)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        process_batch(batch, epoch_id, tables_dir, keys)

    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    if path_exists(spark, table_path(tables_dir, "raw")) and not path_exists(spark, ckpt):
        # Epochs would restart at 0 and overwrite staged batches.
        raise RuntimeError(f"{tables_dir} holds staged batches, but the stream's checkpoint {ckpt} is gone")
    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()


def start_dimension_streams(spark: SparkSession, tables_dir: str, name: str = "dimensions",
                            dimensions: tuple[str, ...] = tuple(DIMENSION_SPECS),
                            available_now: bool = True) -> list[StreamingQuery]:
    """Extend the key map of each dimension by the names that arrive in the staged rows.

    Distinct names are kept by Spark's streaming de-duplication: a batch hands on
    those that were never met before, and only for these is the map read. For
    large dimensions let the state store be RocksDB
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    queries = []
    for dimension in dimensions:
        names, _, _ = DIMENSION_SPECS[dimension]
        staged = spark.readStream.schema(RAW_SCHEMA).option("recursiveFileLookup", "true").parquet(table_path(tables_dir, "raw"))

        def per_batch(batch: DataFrame, epoch_id: int, dimension=dimension) -> None:
            if not batch.isEmpty():
                key_map(spark, tables_dir, dimension).extend(batch)

        ckpt = f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{dimension}"
        writer = names(staged).writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        queries.append(writer.start())
    return queries
