"""Document fingerprints: bottom-k sketches of shingle hashes, DataFrame functions only.

A sketch is the sorted array of the ``k`` smallest 64-bit hashes of a text's
distinct five-word shingles (a shorter text is one shingle; a text without words
has none). Sketches of parts merge into the sketch of the whole: keep the k
smallest of their union. From two sketches follow estimates of resemblance and
containment, from one the number of distinct shingles; a sketch with fewer than k
hashes is the whole set and its answers are exact.

``edited_pairs`` is the report of the registered query. The document that follows
another in descending id is found without a global sort: quantiles of the ids cut
the order into ranges, each a small window, and the ends of the ranges meet in
one row per range.

Defined results: a NULL text counts as empty; two empty sketches resemble each
other fully, an empty and a non-empty one not at all. Rows that share an id share
the next document, the largest smaller id (its smallest text, if several); a row
without an id has an empty next document, and is none itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stocktake.llm.common import let

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
#: Ids that one window range should hold, and the most ranges (their ends meet in one task).
RANGE_IDS, MAX_RANGES = 50_000, 2_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def sketch(text: Column, k: int = SKETCH_SIZE, n: int = SHINGLE_WORDS) -> Column:
    """The k smallest hashes of the distinct n-word shingles, ascending."""
    def hashes(w: Column) -> Column:
        shingles = F.transform(F.sequence(F.lit(0), F.size(w) - n),
                               lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(n))))
        return (F.when(F.size(w) >= n, shingles)
                .when(F.size(w) > 0, F.array(F.xxhash64(w)))
                .otherwise(F.array().cast("array<bigint>")))

    word_ids = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.slice(F.sort_array(F.array_distinct(let(word_ids, hashes))), 1, k)


def merge(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of common shingles among all of both."""
    both = F.array_intersect(a, b)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
            .otherwise(let(merge(a, b, k), lambda u: F.size(F.array_intersect(u, both)) / F.size(u))))


def distinct_shingles(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles: (k - 1) over the k-th hash as a share of the range."""
    kth = (F.element_at(a, -1).cast("double") + 2.0 ** 63) / 2.0 ** 64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / kth)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of a's shingles that b holds too: the common part of the union over a."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    return F.concat_ws(",", F.transform(a, lambda h: F.lower(F.hex(h))))


def next_ids(ids: DataFrame) -> DataFrame:
    """doc_id, next_id for the distinct ids of ``ids``: the next smaller, the largest after the smallest."""
    n = ids.count()
    ranges = min(MAX_RANGES, -(-n // RANGE_IDS))
    cuts: list = []
    if ranges > 1:
        cuts = sorted(set(ids.agg(F.percentile_approx(
            "doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0]))
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0)
    placed = ids.select("doc_id", place.alias("range"))
    ends = placed.groupBy("range").agg(F.max("doc_id").alias("top"))
    ends = (ends.withColumn("below", F.coalesce(F.lead("top").over(W.orderBy(F.desc("range"))),
                                                F.max("top").over(W.partitionBy())))
            .select("range", "below"))
    inside = F.lead("doc_id").over(W.partitionBy("range").orderBy(F.desc("doc_id")))
    return (placed.withColumn("next_id", inside).join(ends, "range")
            .select("doc_id", F.coalesce("next_id", "below").alias("next_id")))


def edited_pairs(docs: DataFrame, k: int = SKETCH_SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    The edited form replaces the last third of the code points by the first as
    many of the next document in descending id.
    """
    # Under one new name and filter on both sides of the joins below, the texts are shuffled once.
    every = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = every.where("id IS NOT NULL")
    third = F.floor(F.length("text") / 3).cast("int")
    need = base.groupBy("id").agg(F.max(third).alias("need"))
    links = need.withColumnRenamed("id", "doc_id").join(next_ids(need.select(F.col("id").alias("doc_id"))), "doc_id")
    # Each document hands its first code points and its sketch to the one before it.
    given = (base.join(links.select(F.col("doc_id").alias("target"), "need", F.col("next_id").alias("id")), "id")
             .select("target", F.struct(F.expr("substring(text, 1, need)").alias("head"),
                                        sketch(F.col("text"), k).alias("sketch")).alias("nxt"))
             .groupBy("target").agg(F.min("nxt").alias("nxt")))
    paired = base.join(given.withColumnRenamed("target", "id"), "id", "left")
    unplaced = every.where("id IS NULL").withColumn("nxt", F.lit(None).cast(paired.schema["nxt"].dataType))
    rows = (paired.unionByName(unplaced).withColumnRenamed("id", "doc_id")
            .withColumn("n_chars", F.length("text").cast("bigint"))
            .withColumn("third", third)
            .withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars AS int) - third)"),
                                           F.expr("substring(coalesce(nxt.head, ''), 1, third)")))
            .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    sketch(F.col("text"), k).alias("a"), sketch(F.col("edited"), k).alias("b"),
                    F.coalesce("nxt.sketch", F.array().cast("array<bigint>")).alias("c")))
    return rows.select("doc_id", "n_chars", "edited_sha256",
                       as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
                       resemblance(F.col("a"), F.col("b"), k).alias("near_edited"),
                       resemblance(F.col("a"), F.col("c"), k).alias("near_next"),
                       distinct_shingles(F.col("a"), k).alias("distinct_shingles"))
