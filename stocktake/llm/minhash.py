"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct word shingles. Its sketch has
``bands * rows`` coordinates filled in rounds: in round i every element is hashed
to a coordinate and a value, and a coordinate keeps the smallest value of the
first round that reached it. After as many rounds as coordinates, round t + j
sends every element to coordinate j, so all are filled. Two sketches agree in a
coordinate with a probability equal to the sets' resemblance, with concentration
as for independent permutations.

Documents with equal sets form a class at once, by a digest of the set. Classes
whose sketches agree in a band share a bucket. A bucket's leader is compared with its
members on full sets and links are contracted into components. Only buckets that
still hold several components go on, led by their members outside the largest
one, until none is left: no pair of a bucket with members in different
components stays undecided, and members that already belong together are not
compared. A bucket's members are dealt to a task per ``SALT_ROWS`` of them, and its
leaders sent to each. Before texts are fetched, sizes and parities of the sets rule out pairs
that cannot be similar, without loss.

With 40 bands of 6 rows a pair at the threshold of 0.8 shares no bucket with a
probability of 6e-6, less above it.

Defined results: text is lower-cased in A-Z only; a text with fewer words than a
shingle is one shingle; a NULL or empty text, or one of white space, has an empty
set and is linked with nothing. Rows that share an id are one document. A row
without an id is linked by its set like any other. A group's document
is that of smallest id, or if no row has an id, that of smallest row key (a hash
of id and text; its 64 bits make some 270 pairs of 1e11 rows meet). ``survivors``
leaves one row of each group. A text is one block in memory: the set and sketch of 64 MB
take less than 2 GB. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stocktake.llm.common import (LOWER, arrow_text, cut_lineage, in_tasks, join_uneven, mix64, rolling, row_blocks,
                                  split_by_ids, tidied, window_hashes, word_hashes)
from stocktake.llm.components import components

BANDS, ROWS = 40, 6
#: Leaders of a bucket per round after the first.
LEADERS = 256
#: Words of 64 bits of the parities by which pairs are ruled out.
PARITY_WORDS = 16
#: Members of a bucket that one task compares with its leaders.
SALT_ROWS = 1000
#: Pairs that one task verifies.
TASK_PAIRS = 1000
#: Bytes of texts whose sets a task keeps while it verifies pairs.
KNOWN_BYTES = 1 << 22
#: The smallest of these names a group's document: ids go before rows without one.
FIRST = "struct(doc_id IS NULL AS no_id, doc_id, key)"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text."""
    words, at = word_hashes(LOWER[data], offsets)
    hashes, starts = window_hashes(words, at, n)
    cut = np.searchsorted(starts, at)
    for i in range(len(offsets) - 1):
        count = at[i + 1] - at[i]
        if count >= n:
            yield np.unique(hashes[cut[i]:cut[i + 1]])
        elif count:
            yield mix64(rolling(words[at[i]:at[i + 1]], np.zeros(1, int), np.array([count])) + np.uint64(count))
        else:
            yield np.zeros(0, np.uint64)


def fill_sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """The t coordinates of a non-empty set, as (round, value) in one number."""
    out = np.zeros(t, np.uint64)
    filled = np.zeros(t, bool)
    at_once = max(1, 1024 // len(elements))  # small sets need many rounds: hash several in one go
    low = 0
    while low < 2 * t:
        rounds = np.arange(low, min(2 * t, low + at_once), dtype=np.uint64)
        h = mix64(elements[None, :] ^ mix64(rounds + np.uint64(1))[:, None])
        place = (h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)
        late = rounds >= t
        if late.any():
            place[late] = (rounds[late] - np.uint64(t))[:, None]
        value = (rounds << np.uint64(32))[:, None] | (h & np.uint64(0xFFFFFFFF))
        key = (place << np.uint64(44) | value).ravel()
        key.sort()
        place = key >> np.uint64(44)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        reached = place[first].astype(np.int64)
        new = ~filled[reached]
        out[reached[new]] = key[first[new]] & np.uint64((1 << 44) - 1)
        filled[reached] = True
        if filled.all():
            break
        low += at_once
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()),
                     ("k2", pa.int64()), ("bands", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])


def parity_bits(elements: np.ndarray) -> np.ndarray:
    """How often each of 64 * PARITY_WORDS hash places is taken by the set, modulo 2."""
    place = (elements >> np.uint64(17)).astype(np.int64) % (64 * PARITY_WORDS)
    return np.packbits(np.bincount(place, minlength=64 * PARITY_WORDS).astype(np.uint8) & 1).view(np.int64)


def sketches(docs: DataFrame, n: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Set size, set digest, band hashes and parities of each row (columns doc_id, key, text)."""
    t = bands * rows
    salt = mix64(np.arange(1, t + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            data, offsets = arrow_text(batch.column(2))
            size, k1, k2, found, parity = [], [], [], [], []
            for low, high in row_blocks(offsets):
                own = offsets[low:high + 1] - offsets[low]
                for s in shingle_sets(data[offsets[low]:offsets[high]], own, n):
                    size.append(len(s))
                    if not len(s):
                        for column in (k1, k2, found, parity):
                            column.append(None)
                        continue
                    parity.append(parity_bits(s))
                    k1.append(int(mix64(s).sum().view(np.int64)))
                    k2.append(int(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().view(np.int64)))
                    h = (fill_sketch(s, t) + salt) * (salt | np.uint64(1))
                    found.append(mix64(mix64(h).reshape(bands, rows).sum(axis=1)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(parity, pa.list_(pa.int64()))], schema=_SCHEMA)

    return docs.mapInArrow(
        tidied(run), "doc_id long, key long, n_shingles long, k1 long, k2 long, bands array<long>, parity array<long>")


def _can_link(percent: int) -> Column:
    """Rules out, without loss, pairs (n, parity) and (an, aparity) below the similarity.

    Sizes must be near enough, and the sets may differ in at most
    (100 - percent) / (100 + percent) of the sum of their sizes; the places where
    their parities differ are never more than the elements in which the sets do.
    """
    differ = F.aggregate(F.zip_with("parity", "aparity", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return ((F.least("n", "an") * 100 >= F.greatest("n", "an") * percent)
            & (differ * (100 + percent) <= (F.col("n") + F.col("an")) * (100 - percent)))


def _key(id_col: str, text_col: str) -> Column:
    """A number that rows share if they agree in id and text."""
    return F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col))


def confirmed(pairs: DataFrame, docs: DataFrame, repeated: DataFrame | None, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of row keys whose full sets reach the similarity.

    Texts travel rather than sets, being smaller; a task keeps the sets of the
    texts that it met last. ``repeated`` are the keys of several rows. ``pairs`` is
    a table of known size.
    """
    n_pairs = pairs.count()
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    maybe, _ = split_by_ids(docs, wanted, "key")
    texts = maybe.join(wanted, "key", "left_semi").select("key", "text")
    if repeated is not None:
        texts = (texts.join(repeated, "key", "left_anti")
                 .unionByName(texts.join(repeated, "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))))
    # Under a new name, so that Spark shuffles the texts once for both joins.
    texts = texts.select(F.col("key").alias("id"), F.col("text").alias("body"))
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("body").alias("at")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("body").alias("bt")), "b").select("a", "b", "at", "bt"))

    def run(batches):
        known: dict[str, np.ndarray] = {}
        held = 0

        def elements(text: str) -> np.ndarray:
            nonlocal held
            if text not in known:
                data = np.frombuffer(text.encode(), np.uint8)
                if held + len(data) > KNOWN_BYTES:
                    known.clear()
                    held = 0
                held += len(data)
                known[text] = next(shingle_sets(data, np.array([0, len(data)]), n))
            return known[text]

        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = elements(a.as_py()), elements(b.as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common * 100 >= (len(x) + len(y) - common) * percent)
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return in_tasks(both, n_pairs, TASK_PAIRS).mapInArrow(tidied(run), "a long, b long")


def _grouped(docs: DataFrame, n: int, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key, n_shingles and component of every row of ``docs`` (columns doc_id, key, text).

    The component, NULL for an empty set, is by similarity alone, whatever the ids.
    """
    drawn = cut_lineage(sketches(docs.select("doc_id", "key", "text"), n, bands, rows))
    n_rows = drawn.count()
    repeated = cut_lineage(drawn.where("n_shingles > 0").groupBy("key").agg(F.count("*").alias("c"))
                           .where("c > 1").select("key"), n_rows)
    repeated = None if repeated.isEmpty() else repeated
    classes = (drawn.where("n_shingles > 0").groupBy("k1", "k2")
               .agg(F.min(F.expr(FIRST)).alias("first"), F.first("n_shingles").alias("n"),
                    F.first("bands").alias("bands"), F.first("parity").alias("parity"))
               .withColumn("node", F.col("first.key")))
    spread = (classes.select("node", "k1", F.posexplode("bands"))
              .select("node", "k1", F.xxhash64("pos", "col").alias("bucket")))
    shared = (spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
              .withColumn("salts", F.ceil(F.col("members") / SALT_ROWS).cast("int")))
    salt = F.pmod(F.xxhash64("node", F.lit("salt")), F.col("salts")).cast("int")
    live = cut_lineage(join_uneven(spread, shared, ["bucket"], "members").where("salts IS NOT NULL")
                       .join(classes.select("node", "k1", "n", "parity"), ["node", "k1"])
                       .select("bucket", "salts", salt.alias("salt"), "node", "n", "parity"), bands * n_rows)
    n_live = live.count()
    to_all = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    first = live.groupBy("bucket").agg(F.min("node").alias("node"))
    lead = live.join(first, ["bucket", "node"])
    links, found = None, None
    while True:
        asked = lead.select("bucket", to_all, F.col("node").alias("a"), F.col("n").alias("an"), F.col("parity").alias("aparity"),
                            *([] if found is None else [F.col("c").alias("ac")]))
        pairs = live.join(asked, ["bucket", "salt"]).where((F.col("a") != F.col("node")) & _can_link(percent))
        if found is not None:
            pairs = pairs.where("c <> ac")
        pairs = cut_lineage(pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(),
                            n_live if found is None else n_live * LEADERS)
        new = cut_lineage(confirmed(pairs, docs, repeated, n, percent))
        if links is None or not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            found = components(links)
        # A bucket whose members are all in one component is settled; its leaders have met all members.
        rest = (live.join(lead.select("bucket", "node"), ["bucket", "node"], "left_anti")
                .select("bucket", "salts", "salt", "node", "n", "parity").join(found, "node", "left")
                .withColumn("c", F.coalesce("component", "node")).drop("component"))
        main = (rest.groupBy("bucket", "salts", "c").agg(F.count("*").alias("k"))
                .groupBy("bucket", "salts").agg(F.max(F.struct("k", "c")).alias("main"), F.count("*").alias("parts"))
                .where("parts > 1").select("bucket", to_all, F.col("main.c").alias("main")))
        live = cut_lineage(rest.join(main, ["bucket", "salt"]), n_live)
        n_live = live.count()
        if not n_live:
            break
        # Members outside a bucket's largest component lead next: the others need no comparison with each other.
        by_bucket = W.partitionBy("bucket").orderBy("node")
        lead = (live.where("c <> main").withColumn("k", F.row_number().over(by_bucket))
                .where(F.col("k") <= LEADERS).drop("k"))
    groups = (classes.select("k1", "k2", "node").join(found, "node", "left")
              .select("k1", "k2", F.coalesce("component", "node").alias("component")))
    return cut_lineage(drawn.join(groups, ["k1", "k2"], "left").select("doc_id", "key", "n_shingles", "component"), n_rows)


def _firsts(grouped: DataFrame) -> DataFrame:
    """component and first, the row that stands for it, of every group of several rows."""
    return cut_lineage(grouped.where("component IS NOT NULL").groupBy("component")
                       .agg(F.min(F.expr(FIRST)).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), grouped.count())


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                       _key(id_col, text_col).alias("key"))
    grouped = _grouped(docs, n, percent, bands, rows)
    # An id with texts in several groups makes them one.
    named = grouped.where("doc_id IS NOT NULL AND component IS NOT NULL")
    several = (named.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("z"))
               .where("a <> z").select("doc_id", "a"))
    links = cut_lineage(named.select("doc_id", F.col("component").alias("b")).join(several, "doc_id")
                        .select("a", "b").distinct(), grouped.count())
    if not links.isEmpty():
        merged = components(links).select(F.col("node").alias("component"), F.col("component").alias("into"))
        grouped = (grouped.join(merged, "component", "left")
                   .withColumn("component", F.coalesce("into", "component")).drop("into"))
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    alone = F.col("first").isNull() | (F.col("first.no_id") & (F.col("first.key") == F.col("key")))
    return (grouped.join(_firsts(grouped), "component", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, alone).alias("kept")))


def survivors(docs: DataFrame, n: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies; rows with an empty set all stay.

    Groups are by similarity alone: unlike texts under one id both stay, like ones
    do not. Of rows that agree in id and text the smallest stays.
    """
    keyed = docs.withColumn("__key", _key(id_col, text_col))
    grouped = _grouped(keyed.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                                    F.col("__key").alias("key")), n, percent, bands, rows)
    members = (grouped.join(_firsts(grouped), "component")
               .groupBy(F.col("key").alias("__key")).agg(F.first(F.col("first.key") == F.col("key")).alias("stays"),
                                                         F.count("*").alias("c")))
    decided = cut_lineage(members.where("NOT stays OR c > 1").select("__key", "stays"), grouped.count())
    gone, repeated = (decided.where(x).select("__key") for x in ("NOT stays", "stays"))
    maybe, kept = split_by_ids(keyed, decided.select("__key"), "__key")
    left = maybe.join(gone, "__key", "left_anti")
    if not repeated.isEmpty():
        once = left.join(repeated, "__key", "left_semi").groupBy("__key").agg(F.min(F.struct(*docs.columns)).alias("row"))
        kept = kept.unionByName(left.join(repeated, "__key", "left_anti"))
        left = once.select("__key", "row.*")
    return kept.unionByName(left).select(*docs.columns)
