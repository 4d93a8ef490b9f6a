"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one vector kept per group.

Equal vectors are one node, with a weight, at once. Centroids come from spherical
k-means on a sample of at most ``SAMPLE_ROWS`` nodes and ``SAMPLE_BYTES`` bytes;
they decide how much work there is, never the result. Every node lives in the cell
of the centroid with the largest cosine. Two vectors within the angle of the
threshold lie in one cell, or one of them is no further than half that angle from
the plane between their cells: each node also visits the cells that it is so near
to. Nothing is lost thereby: pairs are compared in the home of the one that is
visited, and if both visit, in the cell of smaller number.

Nodes within half the angle of a centroid, a cell's core, are all linked with each
other, so a dense group costs no products among them. Neighbouring cells share a
room as long as their rows have at most ``PART_BYTES``, so a row is sent to a room
once for all the cells it visits there; a larger cell has a room to itself, in
parts of that size. A task holds a room or a part and multiplies its cells with the
rows that visit them, some at a time. It passes on a count per node and a spanning
forest of the links, not the pairs. Products are in single precision, and again in
double precision where they come near the threshold.

Defined results: a vector that is NULL, zero, or holds a NULL, NaN or infinity is
linked with nothing, nor is one that is empty; a shorter vector counts as padded
with zeros. Rows without an id take part like others; a group is named by its
smallest id. If it has none, its component and that of an unlinked row without id
are NULL, and kept is true for its rows that are equal to its first by vector hash.
Rows that share an id are vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.common import cut_lineage, join_uneven
from stocktake.llm.components import components

#: Bound of the sample that centroids are fitted on.
SAMPLE_ROWS, SAMPLE_BYTES = 1 << 16, 1 << 25
#: Sample rows per centroid, at least.
ROWS_PER_CENTROID = 32
ROUNDS = 8
#: Bytes of the vectors, as double, that a task holds of a cell at once.
PART_BYTES = 1 << 23
#: Rows by columns of one product.
TILE = 1024


def takes_part(vec: Column) -> Column:
    """True for a vector of finite components that are not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def directions(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors, in double precision, of a list column."""
    column = column.cast(pa.large_list(pa.float64()))
    at = column.offsets.to_numpy()
    values, lengths = column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]], np.diff(at)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(at[:-1] - at[0], lengths)] = values
    out /= np.abs(out).max(axis=1, initial=0, keepdims=True)  # so that no square overflows
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """At most k unit centroids of unit vectors; those without rows go."""
    rng = np.random.default_rng(seed)
    centroids = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(rows[i:i + TILE] @ centroids.T, axis=1) for i in range(0, len(rows), TILE)])
        order = np.argsort(nearest, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(nearest[order]) > 0))
        sums = np.add.reduceat(rows[order], first, axis=0)
        norms = np.sqrt((sums * sums).sum(axis=1))
        centroids = sums[norms > 1e-4] / norms[norms > 1e-4, None]
    return np.unique(centroids, axis=0).astype(np.float64)


def fit(nodes: DataFrame, width: int) -> np.ndarray:
    """Centroids, as many as the square root of the nodes' number if the sample is large enough for them."""
    n = nodes.count()
    size = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * width)))
    draw = F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(1 << 30))
    part = nodes.where(draw < int(min(1.0, 1.2 * size / n) * (1 << 30))).orderBy(draw, "node").limit(size)
    sample = directions(part.select("vec").toArrow().column(0).combine_chunks(), width).astype(np.float32)
    return spherical_kmeans(sample, max(1, min(math.isqrt(n), len(sample) // ROWS_PER_CENTROID)))


def housed(nodes: DataFrame, centroids: np.ndarray, width: int, cosine: float) -> DataFrame:
    """node, weight, vec, cell, core and visits (the other cells that the vector is near) of every node."""
    half = math.acos(cosine) / 2
    slack = 1e-9

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, TILE):
                part = batch.slice(low, TILE)
                near = directions(part.column(2), width) @ centroids.T
                cell = near.argmax(axis=1)
                best = near[np.arange(len(cell)), cell]
                met, which = np.unique(cell, return_inverse=True)
                gap = np.sqrt(np.maximum(2 - 2 * centroids[met] @ centroids.T, 0))  # distances of the centroids
                # The sine of the angle to the plane between two centroids is the difference of cosines by their distance.
                visits = best[:, None] - near <= math.sin(half) * gap[which] + slack
                visits[np.arange(len(cell)), cell] = False
                row, to = np.nonzero(visits)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(cell)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(best >= math.cos(half) + slack),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(to.astype(np.int32)))],
                    names=["node", "weight", "vec", "cell", "core", "visits"])

    kind = nodes.schema["vec"].dataType.simpleString()
    return (nodes.select("node", "weight", "vec")
            .mapInArrow(run, f"node string, weight long, vec {kind}, cell int, core boolean, visits array<int>"))


def rooms(sizes: dict[int, int], centroids: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """Room of each cell, and parts of each room: cells that are near each other, of ``most`` rows together or one alone."""
    left, order = np.ones(len(centroids), bool), [0]
    left[0] = False
    while left.any():  # from each cell to the nearest one left
        near = np.where(left, centroids @ centroids[order[-1]], -2)
        order.append(int(near.argmax()))
        left[order[-1]] = False
    room, parts, held = [0] * len(centroids), [], most + 1
    for cell in order:
        n = sizes.get(cell, 0)
        if held + n > most:
            parts.append(max(1, -(-n // most)))
            held = 0
        held += n
        room[cell] = len(parts) - 1
    return room, parts


class Part:
    """Rows of a room, by cell: unit vectors in two precisions, and what is known of them."""

    def __init__(self, rows: list[pa.RecordBatch], width: int):
        whole = pa.Table.from_batches(rows).combine_chunks()
        order = np.argsort(whole.column("cell").to_numpy(), kind="stable")
        whole = whole.take(order).combine_chunks()
        column = lambda name: pa.concat_arrays(whole.column(name).chunks)
        self.nodes, self.weight = column("node").to_pylist(), column("weight").to_numpy()
        self.fine = directions(column("vec"), width)
        self.rough = self.fine.astype(np.float32)
        self.cell, self.core = column("cell").to_numpy().astype(np.int64), column("core").to_numpy(zero_copy_only=False)
        visits = column("visits")
        n = np.diff(visits.offsets.to_numpy())
        row, to = np.repeat(np.arange(len(n)), n), visits.flatten().to_numpy().astype(np.int64)
        self.visit_keys = np.sort(row << 32 | to)
        by_cell = np.argsort(to, kind="stable")
        self.visitors, self.visited = row[by_cell], to[by_cell]

    def meets(self, cell: int) -> np.ndarray:
        """Rows that live in or visit a cell."""
        low, high = np.searchsorted(self.cell, [cell, cell + 1])
        a, b = np.searchsorted(self.visited, [cell, cell + 1])
        return np.concatenate([np.arange(low, high), self.visitors[a:b]])

    def visit(self, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Whether row[i] visits cell[i]."""
        if not len(self.visit_keys):
            return np.zeros(len(row), bool)
        key = row << 32 | cell
        return self.visit_keys[np.minimum(np.searchsorted(self.visit_keys, key), len(self.visit_keys) - 1)] == key


class Links:
    """Counts of linked vectors, and a spanning forest, of rows that are met one part after the other."""

    def __init__(self):
        self.parent, self.place, self.counts, self.nodes = np.zeros(0, np.int64), {}, np.zeros(0, np.int64), []

    def enter(self, part: Part) -> np.ndarray:
        """Numbers of the part's rows."""
        new = [n for n in part.nodes if n not in self.place]
        self.place.update(zip(new, range(len(self.nodes), len(self.nodes) + len(new))))
        self.nodes += new
        self.parent = np.concatenate([self.parent, np.arange(len(self.parent), len(self.nodes))])
        self.counts = np.concatenate([self.counts, np.zeros(len(new), np.int64)])
        return np.array([self.place[n] for n in part.nodes], np.int64)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Merge the trees of a[i] and b[i]; every parent is the root of its tree, the smallest number."""
        x, y = self.parent[a], self.parent[b]
        while (differ := x != y).any():
            low, high = np.minimum(x, y)[differ], np.maximum(x, y)[differ]
            np.minimum.at(self.parent, high, low)
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up
            x, y = self.parent[x], self.parent[y]

    def meet(self, a: Part, b: Part, cosine: float) -> None:
        """Compare the cells of ``a`` with the rows of ``b`` that live in or visit them; b may be a."""
        at_a, at_b = self.enter(a), self.enter(b)
        margin = 1e-6 * max(1.0, a.fine.shape[1] ** 0.5)
        for cell in np.unique(a.cell).tolist():
            low, high = np.searchsorted(a.cell, [cell, cell + 1])
            others = b.meets(cell)
            for i in range(low, high, TILE):
                mine = np.arange(i, min(i + TILE, high))
                for j in range(0, len(others), TILE):
                    theirs = others[j:j + TILE]
                    near = a.rough[mine] @ b.rough[theirs].T
                    hit = near >= cosine - margin
                    guest = b.cell[theirs] != cell
                    # Pairs of a core are linked without products, see certain().
                    hit &= ~(a.core[mine][:, None] & (b.core[theirs] & ~guest)[None, :])
                    if a is b:
                        hit &= guest[None, :] | (mine[:, None] < theirs[None, :])
                    x, y = np.nonzero(hit)
                    close = near[x, y] < cosine + margin
                    x, y, guest = mine[x], theirs[y], guest[y]
                    good = ~close
                    good[close] = np.einsum("ij,ij->i", a.fine[x[close]], b.fine[y[close]]) >= cosine
                    # Of two that visit each other's cell the pair counts in the smaller one.
                    good &= ~guest | (cell < b.cell[y]) | ~a.visit(x, b.cell[y])
                    x, y = x[good], y[good]
                    np.add.at(self.counts, at_a[x], b.weight[y])
                    np.add.at(self.counts, at_b[y], a.weight[x])
                    self.join(at_a[x], at_b[y])

    def rows(self) -> pa.RecordBatch:
        """node, root and count of all rows with a link."""
        some = np.flatnonzero(self.counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.nodes[i] for i in some], pa.string()), pa.array([self.nodes[i] for i in self.parent[some]], pa.string()),
             pa.array(self.counts[some])], names=["node", "root", "linked"])


def compared(rows: DataFrame, centroids: np.ndarray, width: int, cosine: float) -> DataFrame:
    """node, root, linked: partial counts and links by products within cells."""
    part_rows = max(TILE, PART_BYTES // (8 * width))
    sizes = {r.cell: r.n for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row per centroid
    room_of, parts_of = rooms(sizes, centroids, part_rows)
    look = lambda values, at: F.element_at(F.lit(values), at + 1)
    rows = rows.withColumn("room", look(room_of, F.col("cell")))
    parts = look(parts_of, F.col("room"))
    fields = ["node", "weight", "vec", "cell", "core", "visits"]
    # A row that lives in a room meets the parts up to its own; a visitor meets all.
    lives = (rows.withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), parts).cast("int"))
             .select("room", F.explode(F.sequence(F.lit(0), "part")).alias("host"), "part", *fields)
             .withColumn("side", F.when(F.col("host") == F.col("part"), 0).otherwise(1)).drop("part"))
    elsewhere = F.array_except(F.array_distinct(F.transform("visits", lambda c: look(room_of, c))), F.array("room"))
    guests = (rows.withColumn("room", F.explode(elsewhere))
              .withColumn("visits", F.filter("visits", lambda c: look(room_of, c) == F.col("room")))  # the others are not asked there
              .select("room", F.explode(F.sequence(F.lit(0), parts - 1)).alias("host"), *fields, F.lit(1).alias("side")))

    def run(batches):
        task, home, links, held, count = None, None, None, [], 0

        def settle():
            """Compare the rows held: those at home with each other, or those that meet them."""
            nonlocal home, held, count
            if held:
                now = Part(held, width)
                if home is None:
                    home = now
                links.meet(home, now, cosine)
            held, count = [], 0

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("room", "host", "side")], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                room, host, side = key[low].tolist()
                if task != (room, host):
                    if task is not None:
                        settle()
                        yield links.rows()
                    task, home, links = (room, host), None, Links()
                elif side == 1 and home is None:
                    settle()
                while low < high:
                    take = high - low if side == 0 else min(high - low, part_rows - count)
                    held.append(batch.slice(low, take))
                    low, count = low + take, count + take
                    if side == 1 and count == part_rows:
                        settle()
        if task is not None:
            settle()
            yield links.rows()

    return (lives.unionByName(guests).repartition("room", "host").sortWithinPartitions("room", "host", "side")
            .mapInArrow(run, "node string, root string, linked long"))


def certain(rows: DataFrame) -> DataFrame:
    """node, root, linked of the cells' cores."""
    core = rows.where("core")
    whole = core.groupBy("cell").agg(F.min("node").alias("root"), F.sum("weight").alias("total"))
    return (core.join(F.broadcast(whole), "cell")  # a row per centroid at most
            .select("node", "root", (F.col("total") - F.col("weight")).alias("linked")).where("linked > 0"))


def near_vectors(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec"))
    hash_ = F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(s), F.size("vec"), "vec")), 16, "0") for s in (1, 2)))
    rows = rows.withColumn("node", F.when(takes_part(F.col("vec")), hash_))
    nodes = cut_lineage(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("first"), F.min("vec").alias("vec")))
    width = nodes.agg(F.max(F.size("vec"))).first()[0]
    if width is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    centroids = fit(nodes, width)
    cells = cut_lineage(housed(nodes, centroids, width, cosine))
    links = cut_lineage(compared(cells, centroids, width, cosine).unionByName(certain(cells)))
    counts = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    groups = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = cut_lineage(nodes.drop("vec").join(counts, "node", "left").join(groups, "node", "left")
                        .where("linked > 0 OR weight > 1").withColumn("component", F.coalesce("component", "node")))
    firsts = named.groupBy("component").agg(F.min("first").alias("name"), F.min("node").alias("leader"), F.count("*").alias("rows"))
    named = cut_lineage(join_uneven(named, firsts, ["component"], "rows").select(
        "node", "weight", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).cast("bigint").alias("n_links"), "name",
        (F.col("node") == F.col("leader")).alias("leads")))
    out = join_uneven(rows.drop("vec"), named, ["node"], "weight")
    alone = F.col("n_links").isNull()
    name = F.when(alone, F.col("vec_id")).otherwise(F.col("name"))
    kept = F.when(alone, F.lit(True)).when(F.col("name").isNull(), F.col("leads")).otherwise(
        F.coalesce(F.col("vec_id") == F.col("name"), F.lit(False)))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), name.alias("component_id"), kept.alias("kept"))
