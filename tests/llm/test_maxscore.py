"""MaxScore against full scoring."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktake.llm import maxscore


def brute_force(data, k, every):
    def ints(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(np.float32(x))) for x in v]

    rows = [(i, ints(v)) for i, v in data if i is not None and ints(v) is not None]
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        own = min(v for i, v in rows if i == q)
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("shard,queries", [(4096, 1024), (16, 3)])
def test_against_brute_force(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", shard)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", queries)
    rng = random.Random(1)
    data = [(i, [rng.gauss(0, 0.3) if rng.random() < (0.3 if i % 3 else 1) else 0.0 for _ in range(12)]) for i in range(150)]
    data += [(200 + i, data[7][1]) for i in range(30)]  # one very common vector: ties by id
    data += [(300, None), (301, [None] + [0.1] * 11), (302, [float("nan")] * 12), (303, [float("inf")] * 12), (None, [0.1] * 12),
             (304, [0.5, -0.5]), (305, []), (10, [0.2] * 12), (310, [0.9] * 12), (310, [0.9] * 12)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("vec", F.lit(1))
    got = maxscore.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect()
    assert sorted(map(tuple, got)) == brute_force(data, 5, 10)


def test_few_rows_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, -1.0])], "vec_id long, embedding array<float>")
    got = maxscore.top_k(df, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 256 * 128 - 512 * 256)]
    assert maxscore.top_k(df.limit(0), F.col("vec_id") == 0).collect() == []


def test_sparse_postings_prune_and_stay_exact():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 50, (500, 40)) * (rng.random((500, 40)) < 0.1)
    index = maxscore.Postings(np.arange(500), rows)
    for own in range(0, 500, 25):
        ids, scores = index.search(rows[own], own, 5)
        full = rows @ rows[own]
        want = [i for i in np.lexsort((np.arange(500), -full)) if i != own][:5]
        assert ids.tolist() == want and scores.tolist() == full[want].tolist()


def test_components_too_large_for_a_score_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e30, 0.0]), (2, [float(1 << 22), 1.0]), (3, [3.0, 1.0]), (50, [-1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = maxscore.top_k(df, F.col("vec_id") % 50 == 0, k=5).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [
        (0, 1, 2, (1 << 30) * 256 + 256 * 512), (0, 2, 3, 256 * 256 * 5)]
