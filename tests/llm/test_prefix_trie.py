"""The prefix trie against a plain one built from dicts, and its awkward inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stocktake.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(sequences):
    """Rows of the trie of {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    below = defaultdict(list)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in below[p]) or 1
        saved[p] = sum(saved[q] for q in below[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(below[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def sequences_of(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + s[h:]
    return out


def collected(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def made(seed, n=260, words="ab", longest=9):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "system"]) if t % 5 == 4 else "user", rng.choice(words) * (1 + t % 3))
            for c in range(n) for t in range(rng.randint(1, longest))]


AWKWARD = [(5, None, None, None), (5, 0, "user", "x"), (6, None, "", ""), (6, 0, "user", "x"), (7, 3, "user", "x"),
           (7, 3, "user", "x"), (None, 1, "user", "lost"), (8, 0, "us", "erx"), (9, 0, "user", "é日" * 40_000)]


@pytest.mark.parametrize("rows", [made(1), made(2, words="a"), made(3, n=40, words="abc", longest=60), AWKWARD, AWKWARD[:1]])
def test_trie_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("depth", F.lit("x")).withColumn("at", F.lit(1))
    assert collected(pt.prefix_trie(df)) == brute_force(sequences_of(rows))
    assert pt.prefix_trie(df.limit(0)).collect() == []


@pytest.mark.parametrize("rows", [made(4), made(5, n=450, words="a", longest=8), [r for r in made(6) if r[0] % 100 != 0]])
def test_rebuilt_conversations(spark, rows):
    conv = F.col("conv_id")
    turns = pt.rebuilt(pt.symbols(spark.createDataFrame(rows, SCHEMA)), conv - conv % 100, F.pmod(F.crc32(conv.cast("string")), F.lit(6)))
    assert collected(pt.trie(turns)) == brute_force(rebuilt(sequences_of(rows)))


def test_small_shards_and_pieces_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(pt, "SHARD_TURNS", 50)
    monkeypatch.setattr(pt, "PIECE_IDS", 3)
    rows = made(7, n=500, words="a", longest=4)  # some two hundred conversations end at one node
    assert collected(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(sequences_of(rows))


def test_compacted_nodes_and_handles():
    """After batches: every node under the handle and name of its edge, the number of nodes minimal."""
    rng = random.Random(8)
    strings = [[rng.choice("ab") for _ in range(rng.randint(0, 24))] for _ in range(300)]
    keys = {}
    key = lambda s: keys.setdefault("".join(s), len(keys) + 1)
    trie, ends = pt.ZFastTrie(), []
    for low in range(0, 300, 37):
        batch = strings[low:low + 37]
        ends += trie.insert_batch([([key(s[:d]) for d in range(len(s) + 1)], [0] * (len(s) + 1), [1] * len(s)) for s in batch],
                                  [len(s) for s in batch])
    texts = {"".join(s) for s in strings}
    prefixes = {t[:d] for t in texts for d in range(len(t) + 1)}
    explicit = {p for p in prefixes if p in texts or p + "a" in prefixes and p + "b" in prefixes} | {""}
    path = lambda v: "".join(strings[trie.string[v]][:trie.extent[v]])
    assert sorted(path(v) for v in range(len(trie.extent))) == sorted(explicit)
    assert [path(e) for e in ends] == ["".join(s) for s in strings]
    assert len(trie.handles) == len(trie.names) == len(explicit) - 1
    for v in range(1, len(trie.extent)):
        low, high = trie.extent[trie.parent[v]], trie.extent[v]
        fat = max(range(low + 1, high + 1), key=lambda d: d & -d)
        assert trie.handles[trie.prefix(trie.string[v], fat)] == trie.names[trie.prefix(trie.string[v], low + 1)] == v
