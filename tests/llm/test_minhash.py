"""Near-duplicate groups against brute force, and the sketch's properties."""

import random

import numpy as np
import pytest

from stocktake.llm import minhash
from stocktake.llm.components import components
from stocktake.llm.common import mix64
from tests.llm.fixtures import empty, frame, prose, rows, words


def shingles(text, n):
    w = words(text, lower=True)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_force(data, n, percent):
    """Sorted (id, size, component, kept) by comparing all pairs; in a group without ids one set is kept."""
    sets = [(i, shingles(t, n)) for i, t in data]
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            same_id = sets[x][0] is not None and sets[x][0] == sets[y][0]
            if a and b and (same_id or 100 * len(a & b) >= percent * len(a | b)):
                label[root(x)] = root(y)
    out = []
    for x, (i, s) in enumerate(sets):
        group = [j for y, (j, _) in enumerate(sets) if root(y) == root(x) and j is not None]
        component = min(group) if group else None
        out.append((i, len(s), component, i == component if component is not None else True))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [2, 5])
def test_edge_cases_against_brute_force(spark, n):
    near = " ".join(w if k != 30 else "swapped" for k, w in enumerate(prose(1, 120).split()))
    extra = [(None, near, "en", "a", 0), (None, near + " end", "en", "a", 0)]  # near copies without an id
    got = minhash.near_duplicates(frame(spark, extra), n=n).collect()
    want = brute_force([(r[0], r[1]) for r in [*rows(), *extra]], n, 80)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(r[0] is None and r[2] == 1 for r in want) == 3


def test_hot_buckets_are_dealt_to_several_tasks(spark, monkeypatch):
    """Near copies by the hundred share their buckets; no pair is lost if several tasks share a bucket."""
    monkeypatch.setattr(minhash, "SALT_ROWS", 20)
    monkeypatch.setattr(minhash, "KNOWN_BYTES", 2000)
    rng = random.Random(21)
    base = prose(80, 60).split()
    data = []
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(60), rng.randint(0, 7)):
            copy[at] = f"u{rng.random()}"
        data.append((i, " ".join(copy)))
    data += [(200 + i, prose(81, 40) + f" tail{i}") for i in range(100)]
    got = minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), n=2).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(data, 2, 80)


def test_chains_and_large_groups_against_brute_force(spark):
    rng = random.Random(5)
    data = []
    base = prose(11, 100).split()
    for i in range(24):  # a drifting chain: neighbours alike, ends not
        data.append((1000 - i, " ".join(base)))
        for _ in range(2):
            base[rng.randrange(100)] = f"w{rng.random()}"
    seed = prose(12, 80).split()
    for i in range(80):  # a cloud around one text, many pairs near the threshold
        copy = list(seed)
        for at in rng.sample(range(80), rng.randint(0, 9)):
            copy[at] = f"v{rng.random()}"
        data.append((2000 + i, " ".join(copy)))
    data += [(3000 + i, "the same short text") for i in range(50)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = minhash.near_duplicates(df, n=2).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(data, 2, 80)


def test_few_leaders_need_more_rounds_but_lose_nothing(spark):
    """Weak bands put unlike texts into one bucket; every pair in it is still decided."""
    rng = random.Random(9)
    data = []
    for g in range(6):
        words_ = prose(50 + g, 30).split()
        for i in range(6):
            copy = list(words_)
            copy[rng.randrange(30)] = "other"
            data.append((g * 10 + i, "common start of all texts " + " ".join(copy)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = minhash.near_duplicates(df, n=2, bands=60, rows=1).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(data, 2, 80)


def test_rows_without_id_are_linked_by_similarity(spark):
    """Near copies without an id form a group, join a document's, and bridge two documents."""
    base = prose(70, 100).split()
    far = lambda a, b: " ".join(f"v{i}" if a <= i < b else w for i, w in enumerate(base))
    lone = prose(71, 100)
    data = [(5, far(0, 8)), (None, far(0, 0)), (4, far(90, 98)), (None, lone), (None, lone + " more"), (None, lone)]
    assert len(shingles(data[0][1], 2) & shingles(data[2][1], 2)) * 100 < 80 * len(shingles(data[0][1], 2) | shingles(data[2][1], 2))
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = minhash.near_duplicates(df, n=2).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got if r.component_id} == {(5, 4, False), (4, 4, True), (None, 4, False)}
    alone = {(r.n_shingles, r.kept) for r in got if r.component_id is None}
    assert len(alone) == 2 and sum(kept for _, kept in alone) == 1
    left = minhash.survivors(df, n=2).collect()
    assert sorted(r.doc_id or 0 for r in left) == [0, 4]


def test_empty_table(spark):
    assert minhash.near_duplicates(empty(spark)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 7, 300, 5000])
def test_every_coordinate_is_filled_and_depends_on_the_set_alone(size):
    x = np.unique(mix64(np.arange(size, dtype=np.uint64)))
    s = minhash.fill_sketch(x, 240)
    assert len(s) == 240 and (s[1:] != 0).any()
    assert (minhash.fill_sketch(x[::-1].copy(), 240) == s).all()


def test_agreement_estimates_resemblance():
    for share in (0.3, 0.6, 0.8):
        both = int(1000 * share)
        rest = (1000 - both) // 2
        seen = []
        for seed in range(8):
            x = mix64(np.arange(1000, dtype=np.uint64) + np.uint64(seed * 10_000))
            a, b = x[:both + rest], np.concatenate([x[:both], x[both + rest:both + 2 * rest]])
            seen.append((minhash.fill_sketch(a, 240) == minhash.fill_sketch(b, 240)).mean())
        assert abs(np.mean(seen) - both / (both + 2 * rest)) < 0.04


def test_components_against_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(400, 424)] + [(900, i) for i in range(901, 960)] + [(5, 5)]
    label = {x: x for pair in links for x in pair if pair[0] != pair[1]}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((root(a), root(b)))
            label[high] = low
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in label}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_parities_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(6)
    for _ in range(300):
        size = int(rng.integers(1, 4000))
        x = np.unique(mix64(rng.integers(0, 2**60, size).astype(np.uint64)))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.1], mix64(rng.integers(0, 2**60, size // 10 + 1).astype(np.uint64))]))
        differ = sum(int(v).bit_count() for v in (minhash.parity_bits(x) ^ minhash.parity_bits(y)).view(np.uint64))
        assert differ <= len(np.setxor1d(x, y))
