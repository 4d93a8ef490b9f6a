"""Incremental dimension merge from a file stream: keys stay stable, new names
are appended once, a replayed batch adds nothing."""

import os

from stocktake.schemas import RAW_COLUMNS
from stocktake.session import scratch_path
from stocktake.sources.tables import table_path
from stocktake.streaming.incremental import merge_dimensions, start_listing_stream
from tests.fixtures import ROWS, raw_frame


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _csv(rows):
    def cell(v):
        if v is None:
            return ""
        return '"' + str(v).replace('"', '""') + '"'
    lines = [",".join(RAW_COLUMNS)]
    lines += [",".join(cell(r.get(c)) for c in RAW_COLUMNS) for r in rows]
    return "\n".join(lines) + "\n"


def test_stream_merges_dimensions_incrementally(spark):
    src = _local(scratch_path(spark, "stream-src"))
    out = scratch_path(spark, "stream-out")
    os.makedirs(src)
    with open(os.path.join(src, "batch1.csv"), "w") as fh:
        fh.write(_csv(ROWS[:3]))
    q = start_listing_stream(spark, src, out, name=os.path.basename(out))
    q.awaitTermination(120)
    party1 = {r.name: r.party_id for r in spark.read.parquet(table_path(out, "party")).collect()}
    assert party1 == {" Alpha": 1, "Alpha": 2, "Beta": 3}

    with open(os.path.join(src, "batch2.csv"), "w") as fh:
        fh.write(_csv(ROWS[3:] + [dict(id=99, title="X", developer="Beta",
                                       publisher="Omega")]))
    q = start_listing_stream(spark, src, out, name=os.path.basename(out))
    q.awaitTermination(120)
    party2 = {r.name: r.party_id for r in spark.read.parquet(table_path(out, "party")).collect()}
    assert party2 == {" Alpha": 1, "Alpha": 2, "Beta": 3, "Gamma": 4, "Omega": 5}
    assert spark.read.parquet(table_path(out, "raw")).count() == len(ROWS) + 1
    genres = {r.genre_name for r in spark.read.parquet(table_path(out, "genre")).collect()}
    assert genres == {"action", "rpg", "a", "b", '"x"'}


def test_replayed_batch_adds_nothing(spark):
    out = scratch_path(spark, "merge-out")
    batch = raw_frame(spark)
    merge_dimensions(batch, out)
    merge_dimensions(batch, out)
    party = spark.read.parquet(table_path(out, "party"))
    assert party.count() == 4 and party.select("name").distinct().count() == 4


def test_replayed_batch_adds_nothing_hash_keys(spark):
    from pyspark.sql import functions as F
    out = scratch_path(spark, "merge-hash")
    batch = raw_frame(spark)
    merge_dimensions(batch, out, keys="hash")
    merge_dimensions(batch, out, keys="hash")
    party = spark.read.parquet(table_path(out, "party"))
    assert party.count() == 4
    assert party.where(F.col("party_id") != F.xxhash64("name")).count() == 0


def test_replayed_micro_batch_is_idempotent(spark):
    from stocktake.streaming.incremental import process_batch
    out = scratch_path(spark, "replay")
    batch = raw_frame(spark)
    process_batch(batch, 0, out)
    process_batch(batch, 0, out)          # the same epoch again, as after a failure
    process_batch(raw_frame(spark, ROWS[:2]), 1, out)
    assert spark.read.parquet(table_path(out, "raw")).count() == len(ROWS) + 2
    assert spark.read.parquet(table_path(out, "party")).count() == 4
