"""Near vectors against all pairs, and their awkward inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktake.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, cosine=0.95):
    """(vec_id, n_links, component_id, kept) of rows with ids."""
    good = [(i, np.array(v, np.float64)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in good), default=0)
    unit = np.array([np.pad(v, (0, width - len(v))) / np.sqrt((v * v).sum()) for _, v in good]).reshape(len(good), width)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    label = np.arange(len(good))
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(good))])
        if (new == label).all():
            break
        label = new
    ids = np.array([i for i, _ in good])
    out = {i: (0, i) for i, _ in rows}
    for k, (i, _) in enumerate(good):
        out[i] = (int(near[k].sum()), int(ids[label == label[k]].min()))
    return sorted((i, n, c, i == c) for i, (n, c) in out.items())


def collected(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def frame(spark, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], 0) for i, v in rows], SCHEMA)
    return df.repartition(5).withColumn("node", F.lit("x")).withColumn("cell", F.lit("x")).withColumn("weight", F.lit("x"))


def as_stored(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def planted(seed, n=900, dim=16):
    """Vectors with noise at all distances around the threshold, a dense group, a loose chain and equal ones."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dim) for _ in range(n // 3)]
    for _ in range(n // 3):
        base = rows[rng.integers(len(rows))]
        rows.append(rng.uniform(0.1, 9) * (base + rng.uniform(0, 0.6) * rng.normal(size=dim)))
    dense, chain = rng.normal(size=dim), rng.normal(size=dim)
    rows += [dense + rng.uniform(0, 0.2) * rng.normal(size=dim) for _ in range(n // 6)]
    for _ in range(n // 12):
        chain = chain + 0.22 * rng.normal(size=dim)
        rows.append(chain)
    rows += [rows[3]] * 7 + [2 * rows[3], 3 * rows[400 % len(rows)]]
    order = rng.permutation(len(rows))
    return as_stored([(int(order[i]) * 3 - 50, v) for i, v in enumerate(rows)])


@pytest.mark.parametrize("part_bytes,seed", [(1 << 23, 1), (1, 2)])
def test_links_match_all_pairs(spark, monkeypatch, part_bytes, seed):
    monkeypatch.setattr(ed, "PART_BYTES", part_bytes)
    monkeypatch.setattr(ed, "TILE", 16)  # and so parts of 16 rows
    rows = planted(seed)
    want = brute_force(rows)
    assert sum(n for _, n, _, _ in want) > 2000
    assert collected(ed.near_vectors(frame(spark, rows))) == want


def test_two_dimensions_and_a_low_threshold(spark):
    rng = np.random.default_rng(3)
    rows = as_stored([(i, [np.cos(a), np.sin(a)]) for i, a in enumerate(rng.uniform(0, 2 * np.pi, 300))])
    for cosine in (0.9999, 0.3):
        assert collected(ed.near_vectors(frame(spark, rows), cosine)) == brute_force(rows, cosine)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = as_stored([(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, [2.0, 0.0, 0.0]),
                      (9, [3e38, 1e30]), (10, [1e-40, 0.0]), (11, [-1.0]), (12, [-0.0, 1.0]), (13, [0.0, 1.0])])
    assert collected(ed.near_vectors(frame(spark, rows))) == brute_force(rows)
    only_bad = rows[:6]
    assert collected(ed.near_vectors(frame(spark, only_bad))) == [(i, 0, i, True) for i in range(1, 7)]
    assert ed.near_vectors(frame(spark, rows).limit(0)).collect() == []


def test_rows_without_id_and_shared_ids(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [1.0, 0.01]), (5, [0.0, 1.0]), (None, [0.0, 1.0]), (6, [0.0, 1.0]), (6, [1.0, -1.0]), (None, [-1.0, -1.0])]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.near_vectors(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([
        *[x for x in got if x[2] is None and x[1] == 2], (5, 2, 5, True), (None, 2, 5, False), (6, 2, 5, False), (6, 0, 6, True), (None, 0, None, True)], key=str)
    unnamed = [x for x in got if x[2] is None and x[1] == 2]
    assert len(unnamed) == 3 and sum(x[3] for x in unnamed) in (1, 2)


def test_hot_group_costs_no_products(spark, monkeypatch):
    """A dense third of all rows is linked as a core, whatever its size."""
    rng = np.random.default_rng(4)
    rows = [rng.normal(size=24) for _ in range(400)]
    rows += [np.ones(24) + 0.02 * rng.normal(size=24) for _ in range(200)]
    rows = as_stored(list(enumerate(rows)))
    assert collected(ed.near_vectors(frame(spark, rows))) == brute_force(rows)
    unit = np.array([np.array(v) / np.linalg.norm(v) for _, v in rows])
    found = spark.createDataFrame([(str(i), 1, [float(x) for x in v]) for i, v in rows], "node string, weight long, vec array<float>")
    cells = ed.housed(found, ed.spherical_kmeans(unit, 10), 24, 0.95)
    assert cells.where("core").count() >= 200


def test_sample_bounds(spark, monkeypatch):
    monkeypatch.setattr(ed, "SAMPLE_ROWS", 40)
    rows = planted(5, 600)
    assert collected(ed.near_vectors(frame(spark, rows))) == brute_force(rows)
