"""Keys that outlive rebuilds and streams."""

import os

import pytest
from pyspark.sql import functions as F

from stocktake.operators import keymap
from stocktake.operators.keymap import KeyMap
from stocktake.plans.normalize import DIMENSION_SPECS, Catalog, key_map, normalize
from stocktake.session import scratch_path
from stocktake.streaming import incremental
from tests.fixtures import ROWS, raw_frame
from tests.test_streaming import _csv, _local


def _keys(df, key, name):
    return {r[name]: r[key] for r in df.select(key, name).collect()}


def test_names_keep_their_keys(spark):
    m = KeyMap(spark, scratch_path(spark, "map"), "name", "k", buckets=4)
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    assert m.extend(names("b", "a", None, "b")) == 2 and _keys(m.stored(), "k", "name") == {"a": 1, "b": 2}
    assert m.extend(names("a", "0", "z")) == 2 and m.extend(names("z", "a")) == 0 and m.extend(names()) == 0
    assert _keys(m.stored(), "k", "name") == {"a": 1, "b": 2, "0": 3, "z": 4} and m.top() == 4
    assert _keys(m.keyed(names("z", "new")), "k", "name") == {"z": 4, "new": 5}
    assert _keys(m.stored(), "k", "name") == {"a": 1, "b": 2, "0": 3, "z": 4, "new": 5}


def test_an_extension_cut_short_reuses_no_key(spark):
    path = scratch_path(spark, "map-cut")
    m = KeyMap(spark, path, "name", "k")
    spark.createDataFrame([(2, "y", 0)], "k long, name string, bucket int").withColumn(
        "bucket", m._bucket()).write.partitionBy("bucket").parquet(f"{path}/upto=3")  # of three names one arrived
    assert m.extend(spark.createDataFrame([("x",), ("y",), ("w",)], "name string")) == 2
    assert _keys(m.stored(), "k", "name") == {"y": 2, "w": 4, "x": 5}


def test_only_buckets_at_hand_are_read(spark):
    m = KeyMap(spark, scratch_path(spark, "map-buckets"), "name", "k")
    m.extend(spark.range(2000).selectExpr("concat('n', id) AS name"))
    one = spark.createDataFrame([("n5",)], "name string").select(m._bucket()).first()[0]
    plan = m.stored([one])._jdf.queryExecution().executedPlan().toString()
    assert f"= {one})], PushedFilters" in plan  # a filter on folders
    assert m.stored([one]).count() < 100


def test_rebuild_after_a_stream_keeps_every_key(spark):
    src, out = _local(scratch_path(spark, "keep-src")), scratch_path(spark, "keep-out")
    os.makedirs(src)
    for n, rows in (("1", ROWS[4:]), ("2", ROWS[:2])):
        with open(os.path.join(src, f"{n}.csv"), "w") as fh:
            fh.write(_csv(rows))
        incremental.start_listing_stream(spark, src, out, name=os.path.basename(out)).awaitTermination(120)
    streamed = {d: _keys(key_map(spark, out, d).stored(), k, n) for d, (_, n, k) in DIMENSION_SPECS.items()}
    rebuilt = normalize(raw_frame(spark), key_maps=out)
    for d, (_, n, k) in DIMENSION_SPECS.items():
        now = _keys(rebuilt[d], k, n)
        assert streamed[d].items() <= now.items() and len(set(now.values())) == len(now)
    assert set(_keys(rebuilt["party"], "party_id", "name")) == {"Alpha", "Beta", " Alpha", "Gamma"}
    # The facts point at the kept keys: names are as in a catalogue with keys of its own.
    def named(cat):
        party = cat["party"].withColumnRenamed("party_id", "publisher_id")
        return sorted((r.title_id, r.name or "") for r in cat["inventory"].join(party, "publisher_id", "left").collect())
    assert named(rebuilt) == named(Catalog(raw_frame(spark)))
    again = normalize(raw_frame(spark, ROWS[3:]), key_maps=out)
    assert _keys(again["party"], "party_id", "name").items() <= _keys(rebuilt["party"], "party_id", "name").items()


def test_a_batch_without_new_names_reads_no_dimension(spark, monkeypatch):
    src, out = _local(scratch_path(spark, "state-src")), scratch_path(spark, "state-out")
    os.makedirs(src)

    def arrive(n, rows):
        with open(os.path.join(src, f"{n}.csv"), "w") as fh:
            fh.write(_csv(rows))
        incremental.start_listing_stream(spark, src, out, name=os.path.basename(out), keys=None).awaitTermination(120)
        for q in incremental.start_dimension_streams(spark, out, name=os.path.basename(out)):
            q.awaitTermination(120)
            assert q.exception() is None

    arrive("1", ROWS[:4])
    first = _keys(key_map(spark, out, "party").stored(), "party_id", "name")
    assert first == {"Alpha": 2, "Beta": 3, " Alpha": 1, "Gamma": 4}
    with monkeypatch.context() as m:
        def read(*a, **kw):
            raise AssertionError("the dimension was read")
        m.setattr(keymap.KeyMap, "stored", read)
        m.setattr(keymap.KeyMap, "top", read)
        arrive("2", [dict(r, id=r["id"] + 100) for r in ROWS[:3]])
    arrive("3", [dict(ROWS[0], id=301, developer="Delta")])
    assert _keys(key_map(spark, out, "party").stored(), "party_id", "name") == {**first, "Delta": 5}
    assert spark.read.parquet(f"{out}/raw.parquet").count() == 8
