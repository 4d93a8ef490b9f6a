"""Prefix trie of conversations, by z-fast tries that are grown in tasks and merged.

A conversation is a string of turns; a turn is a symbol, 128 bits of hash of role
and text. Every prefix has a hash, a polynomial over its symbols (128 bits, with
the depth as part of the key), so that a prefix of any depth is looked up at once.

A task grows a z-fast trie of the conversations it meets. Compacted nodes are
hashed at their handle: of the depths on the node's edge the one that the highest
power of two divides. A fat binary search over the handles finds the node where a
conversation leaves the trie. Conversations come in batches: all of a batch are
located first, then inserted node by node, each from the deepest node known to
match. At the end, or once the trie holds ``SHARD_TURNS`` turns, counts are summed
up the compacted nodes and edges expanded into one row per depth; so what
conversations of a task share leaves it once. Spark merges the rows of all tasks
by depth and prefix hash.

A node belongs to its smallest member, so a conversation owns the last part of its
own path, from some depth to its end. Sums over subtrees follow from that: inside
such a part they are running sums, and a second pass of the same tries adds each
part's total to all prefixes above it. No node meets all its descendants.

Defined results: a NULL role or text is empty; turns are ordered with NULL first,
turns that tie by their hashes, and repeated rows are turns of their own. Rows
without conv_id take no part. An empty table has no node, not even a root. A
conversation's hashes (24 bytes a turn) are held by one task, its texts never. The
ids that end at one node are hashed in order by one task, from pieces of a bounded
size that were made in parallel. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stocktake.llm.common import BASE, cut_lineage, join_uneven, powers

SHARD_TURNS = 1 << 19
#: Ids that one piece of a node's id list holds.
PIECE_IDS = 4096
KEY = ["depth", "p1", "p2"]


def symbols(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv_id, at (position from 0), k1, k2 and n_chars of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("k1"), F.xxhash64(F.lit(2), role, text).alias("k2"),
        F.length(text).cast("bigint").alias("n_chars"))
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "k1", "k2", "n_chars")
    return rows.withColumn("at", F.row_number().over(order) - 1).select("conv_id", "at", "k1", "k2", "n_chars")


def paths(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and the arrays k1, k2, n_chars in order of ``at``.

    A row of ``turns`` without k1 stands for the conversation alone, not for a turn.
    """
    listed = F.array_sort(F.collect_list(F.when(F.col("k1").isNotNull(), F.struct("at", "k1", "k2", "n_chars"))))
    return turns.groupBy("conv_id").agg(listed.alias("t")).select("conv_id", "t.k1", "t.k2", "t.n_chars")


class ZFastTrie:
    """Compacted trie of strings that are given by the hashes of all their prefixes.

    ``prefix(string, d)`` is the key of the first d symbols. Node 0 is the root.
    """

    def __init__(self):
        self.p1, self.p2, self.chars = [], [], []  # by string
        self.extent, self.string, self.parent = [0], [0], [-1]  # by node: depth, a string through it, the node above
        self.handles: dict[tuple, int] = {}
        self.names: dict[tuple, int] = {}  # nodes by the first depth of their edge
        self.turns = 0

    def prefix(self, s: int, d: int) -> tuple:
        return d, int(self.p1[s][d]), int(self.p2[s][d])

    @staticmethod
    def fattest(a: int, b: int) -> int:
        """Of the numbers a + 1 to b the one with most factors of two."""
        return b & -(1 << ((a ^ b).bit_length() - 1))

    def locate(self, s: int, n: int, node: int = 0) -> tuple[int, int]:
        """The deepest node, from ``node`` on, that string s matches in full, and the node on whose edge s ends or leaves.

        The second is -1 if s goes on below the first where nothing is yet.
        """
        low, high = self.extent[node], n
        while low < high:
            f = self.fattest(low, high)
            hit = self.handles.get(self.prefix(s, f))
            if hit is None:
                high = f - 1
                continue
            e = self.extent[hit]
            if e > n or self.prefix(s, e) != self.prefix(self.string[hit], e):
                return self.parent[hit], hit
            node, low = hit, e
        if low == n:
            return node, node
        return node, self.names.get(self.prefix(s, low + 1), -1)

    def _hang(self, node: int, above: int) -> None:
        """Enter ``node``'s edge, which begins below ``above``, under its name and handle."""
        self.parent[node] = above
        a, e, s = self.extent[above], self.extent[node], self.string[node]
        self.names[self.prefix(s, a + 1)] = node
        self.handles[self.prefix(s, self.fattest(a, e))] = node

    def _add(self, s: int, extent: int, above: int) -> int:
        self.extent.append(extent)
        self.string.append(s)
        self.parent.append(above)
        self._hang(len(self.extent) - 1, above)
        return len(self.extent) - 1

    def insert(self, s: int, n: int, node: int) -> int:
        """The node at which string s ends, made if need be; ``node`` is a node that s matches in full."""
        node, exit_ = self.locate(s, n, node)
        if exit_ == node:
            return node
        if exit_ < 0:
            return self._add(s, n, node)
        low, high = self.extent[node], min(n, self.extent[exit_] - 1)
        while low < high:  # the depth at which s leaves the edge
            mid = (low + high + 1) // 2
            if self.prefix(s, mid) == self.prefix(self.string[exit_], mid):
                low = mid
            else:
                high = mid - 1
        del self.handles[self.prefix(self.string[exit_], self.fattest(self.extent[node], self.extent[exit_]))]
        middle = self._add(self.string[exit_], low, node)
        self._hang(exit_, middle)
        return middle if low == n else self._add(s, n, middle)

    def insert_batch(self, strings: list[tuple[np.ndarray, np.ndarray, np.ndarray]], lengths: list[int]) -> list[int]:
        """Add strings (hashes p1, p2 of depths 0 to n, symbol sizes); the node at which each ends."""
        first = len(self.p1)
        for p1, p2, chars in strings:
            self.p1.append(p1)
            self.p2.append(p2)
            self.chars.append(chars)
            self.turns += len(p1)
        found = [(self.locate(first + i, n), i) for i, n in enumerate(lengths)]
        ends = [0] * len(lengths)
        for (matched, _), i in sorted(found):
            ends[i] = self.insert(first + i, lengths[i], matched)
        return ends

    def expand(self, ends: np.ndarray, sums: np.ndarray, least: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
        """A row for every depth of every edge: what ends at or below it, summed, and the least ``least``."""
        n = len(self.extent)
        total, smallest = np.zeros((n, sums.shape[1]), np.int64), np.full(n, np.iinfo(np.int64).max)
        np.add.at(total, ends, sums)
        np.minimum.at(smallest, ends, least)
        for v in sorted(range(1, n), key=lambda v: -self.extent[v]):
            total[self.parent[v]] += total[v]
            smallest[self.parent[v]] = min(smallest[self.parent[v]], smallest[v])
        held, rows = [], 0
        for v in range(n):
            low = self.extent[self.parent[v]] + 1 if v else 0
            held.append((v, low, self.extent[v] + 1))
            rows += held[-1][2] - low
            if rows >= 1 << 16 or v == n - 1:
                yield self._rows(held, total, smallest)
                held, rows = [], 0

    def _rows(self, edges: list[tuple[int, int, int]], total: np.ndarray, smallest: np.ndarray) -> dict[str, np.ndarray]:
        times = [high - low for _, low, high in edges]
        nodes = np.repeat([v for v, _, _ in edges], times)
        cut = lambda of, by: np.concatenate(
            [of[self.string[v]][max(0, low - by):high - by] if low >= by else
             np.concatenate([np.zeros(by, of[0].dtype), of[self.string[v]][:high - by]]) for v, low, high in edges])
        return {"depth": np.concatenate([np.arange(low, high) for _, low, high in edges]),
                "p1": cut(self.p1, 0), "p2": cut(self.p2, 0), "q1": cut(self.p1, 1), "q2": cut(self.p2, 1),
                "n_chars": cut(self.chars, 1), "a": total[nodes, 0], "b": total[nodes, 1], "least": smallest[nodes]}


_FIELDS = ["depth", "p1", "p2", "q1", "q2", "n_chars", "a", "b", "least"]


def _lists(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values and the n + 1 offsets of a list column without NULLs."""
    column = column.cast(pa.large_list(pa.int64()))
    at = column.offsets.to_numpy()
    return column.values.to_numpy()[at[0]:at[-1]].astype(kind) if len(column) else np.zeros(0, kind), at - at[0]


def prefix_hashes(values: np.ndarray, at: np.ndarray, base: int) -> np.ndarray:
    """For each list: the hashes of its prefixes of 0 to n values, n + 1 in a row."""
    place = np.arange(len(values)) - np.repeat(at[:-1], np.diff(at))
    p, _ = powers(base, int(np.diff(at).max(initial=0)) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * p[place], dtype=np.uint64)])
    out = np.repeat(np.arange(len(at) - 1), np.diff(at) + 1)  # each list has one prefix more than values
    return sums[np.arange(len(out)) - out] - sums[at[:-1]][out]


def _strings(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """p1, p2 (as signed numbers) and symbol sizes of each path of a batch of columns conv_id, k1, k2, n_chars."""
    k1, at = _lists(batch.column(1), np.uint64)
    k2, _ = _lists(batch.column(2), np.uint64)
    chars, _ = _lists(batch.column(3), np.int64)
    h1, h2 = (prefix_hashes(k, at, b).view(np.int64) for k, b in ((k1, BASE), (k2, BASE ^ (1 << 32))))
    return [(h1[a + i:b + i + 1], h2[a + i:b + i + 1], chars[a:b]) for i, (a, b) in enumerate(zip(at[:-1], at[1:]))]


def expanded(rows: DataFrame) -> DataFrame:
    """Trie rows, of each task by itself, of ``rows`` (conv_id, k1, k2, n_chars, length, a, b).

    The first ``length`` turns of a path are inserted, with the amounts a and b.
    """
    def run(batches):
        trie, ends, amounts, ids = ZFastTrie(), [], [], []

        def flush():
            if ends:
                for part in trie.expand(np.concatenate(ends), np.concatenate(amounts), np.concatenate(ids)):
                    yield pa.RecordBatch.from_pydict({f: pa.array(part[f], pa.int64()) for f in _FIELDS})

        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                ends.append(np.array(trie.insert_batch(_strings(part), part.column(4).to_pylist()), np.int64))
                amounts.append(np.stack([part.column(5).to_numpy(), part.column(6).to_numpy()], axis=1))
                ids.append(part.column(0).to_numpy())
                if trie.turns >= SHARD_TURNS:
                    yield from flush()
                    trie, ends, amounts, ids = ZFastTrie(), [], [], []
        yield from flush()

    return (rows.select("conv_id", "k1", "k2", "n_chars", F.col("length").cast("bigint"), F.col("a").cast("bigint"),
                        F.col("b").cast("bigint")).mapInArrow(run, ", ".join(f"{f} long" for f in _FIELDS)))


def end_digests(held: DataFrame) -> DataFrame:
    """Key of the node at which conversations end, and the SHA-256 of their ids, ascending and joined by commas."""
    def ends(batches):
        for batch in batches:
            found = _strings(batch)
            yield pa.RecordBatch.from_pydict({
                "depth": pa.array([len(c) for _, _, c in found], pa.int64()), "p1": pa.array([int(p[-1]) for p, _, _ in found], pa.int64()),
                "p2": pa.array([int(p[-1]) for _, p, _ in found], pa.int64()), "conv_id": batch.column(0)})

    def runs(batches, of):
        """(key, values) of rows that follow each other with one key, at most PIECE_IDS values at once."""
        for batch in batches:
            last, values = None, []
            for *key, value in zip(*(batch.column(k).to_pylist() for k in of)):
                if key != last or len(values) == PIECE_IDS:
                    if values:
                        yield last, values
                    last, values = key, []
                values.append(value)
            if values:
                yield last, values

    def together(found, schema):
        while some := list(itertools.islice(found, 256)):
            yield pa.RecordBatch.from_pylist(some, schema=schema)

    def pieces(batches):
        yield from together((dict(zip(KEY, key), first=ids[0], ids=",".join(map(str, ids))) for key, ids in runs(batches, range(4))), piece)

    def digests(batches):
        yield from together(digested(batches), digest)

    def digested(batches):
        last, state = None, None
        for key, texts in runs(batches, (0, 1, 2, 4)):
            if key != last:
                if last is not None:
                    yield dict(zip(KEY, last), ends=state.hexdigest())
                last, state = key, hashlib.sha256()
                state.update(texts.pop(0).encode())
            for text in texts:
                state.update(b"," + text.encode())
        if last is not None:
            yield dict(zip(KEY, last), ends=state.hexdigest())

    key = [(k, pa.int64()) for k in KEY]
    piece, digest = pa.schema([*key, ("first", pa.int64()), ("ids", pa.string())]), pa.schema([*key, ("ends", pa.string())])
    return (held.mapInArrow(ends, "depth long, p1 long, p2 long, conv_id long")
            .repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
            .mapInArrow(pieces, "depth long, p1 long, p2 long, first long, ids string")
            .repartition(*KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(digests, "depth long, p1 long, p2 long, ends string"))


def trie(turns: DataFrame) -> DataFrame:
    """The trie's nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    held = cut_lineage(paths(turns))
    merged = lambda rows, *aggs: rows.groupBy(*KEY).agg(*aggs)
    one = held.select("*", F.size("k1").alias("length"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    nodes = cut_lineage(merged(expanded(one), F.min("least").alias("conv_id"), F.sum("a").alias("n_convs"),
                               *(F.min(c).alias(c) for c in ("q1", "q2", "n_chars"))))
    above = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = nodes.where("depth > 0").select(*above).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # What a conversation owns is the last part of its path: sums from a node to the end of the part.
    part = W.partitionBy("conv_id").orderBy(F.desc("depth"))
    nodes = cut_lineage(nodes.withColumns({
        "leaves": F.sum((F.col("n_children") == 0).cast("bigint")).over(part),
        "saved": F.sum((F.col("n_convs") - 1) * F.col("n_chars")).over(part),
        "top": F.min("depth").over(W.partitionBy("conv_id"))}))
    tops = nodes.where("depth = top AND depth > 0")
    owed = (held.join(tops.select("conv_id", "top", F.col("leaves").alias("a"), F.col("saved").alias("b")), "conv_id")
            .withColumn("length", F.col("top") - 1))
    below = merged(expanded(owed), F.sum("a").alias("more_leaves"), F.sum("b").alias("more_saved"))
    parents = nodes.where("n_children > 0").select(*KEY, F.col("conv_id").alias("parent"), F.col("n_children").alias("rows"))
    upward = join_uneven(tops.select(*KEY, *(c.alias(f"u_{n}") for c, n in zip(above, KEY))),
                         parents.select(*(F.col(k).alias(f"u_{k}") for k in KEY), "parent", "rows"),
                         [f"u_{k}" for k in KEY], "rows").select(*KEY, "parent")
    out = nodes.join(below, KEY, "left").join(upward, KEY, "left").join(end_digests(held), KEY, "left")
    parent = F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent"))
    whole = lambda own, more: (F.col(own) + F.coalesce(F.col(more), F.lit(0))).cast("bigint")
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children",
                      whole("leaves", "more_leaves").alias("n_leaves"), whole("saved", "more_saved").alias("saved_tokens"),
                      F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The trie of ``conversations`` as they are (one row per turn)."""
    return trie(symbols(conversations, **columns))


def rebuilt(turns: DataFrame, base: Column, borrowed: Column) -> DataFrame:
    """Turn rows (see :func:`symbols`) of conversations that begin like others.

    Conversation c gets the first ``borrowed`` turns of conversation ``base`` and
    its own turns after as many; both are columns over conv_id.
    """
    turns = cut_lineage(turns)
    ids = turns.groupBy("conv_id").agg(F.lit(1).alias("known")).select("conv_id", base.alias("base"), borrowed.alias("h"))
    most = ids.agg(F.max("h")).first()[0] or 0
    heads = turns.where(F.col("at") < most).withColumnRenamed("conv_id", "base")
    begun = ids.join(heads, "base").where("at < h").select(*turns.columns)
    return (begun.unionByName(turns.withColumn("h", borrowed).where("at >= h").drop("h"))
            .unionByName(ids.select("conv_id", F.lit(-1).alias("at"), *(F.lit(None).cast("bigint").alias(c) for c in ("k1", "k2", "n_chars")))))
