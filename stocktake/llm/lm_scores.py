"""Stupid-backoff scores of every document under the n-gram counts of all others.

Counts of word n-grams of orders 1 to 3 are gathered over all documents, copies
included, in tables partitioned by n-gram hash; each document's n-grams meet
their counts there (see ``chunks``) and the scores are summed per document. A
document's own occurrences are taken off first, so a score says how well the rest
of the corpus predicts it: with c the counts of the other documents,

    c(uvw) / c(uv)        if c(uvw) > 0, else
    0.4 c(vw) / c(v)      if c(vw) > 0, else
    0.16 c(w) / N         if c(w) > 0, else 0.064 / N,

with N the words of all documents. Text is lower-cased in A-Z. Logarithms are
summed in whole millionths, so the sum does not depend on order. Hashes keep 56 bits
(60 took 4.0 and 64 took 4.1 times the input on disk, with chunks of 3 MB): of 1e10 distinct n-grams some 700 pairs meet.
Such totals are too high; none is taken for more than those of the n-gram's parts, so what it is divided by is never 0.

Defined results: a NULL text, or one without words, has 0 words, a log of 0 and a NULL mean;
copies of a text, also in rows that repeat wholly, count as other documents (so a text
that occurs twice is predicted by its copy). Other columns are ignored, whatever their
names. A text is one block in memory, of some 50 times its bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.chunks import text_digest, with_totals
from stocktake.llm.common import LOWER, WORD, mix64, window_hashes, word_hashes

# The factors after one step back, two, and three.
BACKOFF = (0.4, 0.16, 0.064)
#: Of a chunk's texts. Smaller chunks send more and smaller packets.
CHUNK_BYTES = 6 << 20


def ngram_items(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text its 1-, then its 2-, then its 3-grams."""
    words, at = word_hashes(LOWER[data], offsets)
    n = np.diff(at)
    grams = [mix64(words + np.uint64(1)), window_hashes(words, at, 2)[0], window_hashes(words, at, 3)[0]]
    sizes = [n, np.maximum(n - 1, 0), np.maximum(n - 2, 0)]
    counts = sum(sizes)
    out = np.zeros(counts.sum(), np.uint64)
    base = np.cumsum(counts) - counts
    for g, size in zip(grams, sizes):
        shift = base - (np.cumsum(size) - size)
        out[np.arange(len(g)) + np.repeat(shift, size)] = g & ~np.uint64(255)
        base = base + size
    return out, counts


def log_score(words: int, totals: np.ndarray, n_all: int) -> int:
    """Sum of log scores of one text, in millionths, from the others' counts of its items."""
    one, two, three = np.split(totals, [words, 2 * words - 1])
    # No n-gram occurs more often than its parts: a total above theirs holds another n-gram's of the same hash.
    two = np.minimum(two, np.minimum(one[:-1], one[1:]))
    three = np.minimum(three, np.minimum(two[:-1], two[1:]))
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(one > 0, BACKOFF[1] * one / n_all, BACKOFF[2] / n_all)
        if words > 1:
            score[1:] = np.where(two > 0, BACKOFF[0] * two / one[:-1], score[1:])
        if words > 2:
            score[2:] = np.where(three > 0, three / two[:-1], score[2:])
        return int(np.rint(np.log(score) * 1e6).sum())


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, log_micro, mean_log) of every row; log_micro is in millionths."""
    n_all = docs.agg(F.sum(F.regexp_count(F.col(text_col), F.lit(WORD)))).first()[0] or 0

    def results(data, offsets, copies, counts, totals):
        ends = np.cumsum(counts)
        for i in range(len(copies)):
            if not counts[i]:
                yield 0, 0
                continue
            keys, _ = ngram_items(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
            _, place, own = np.unique(keys, return_inverse=True, return_counts=True)
            words = (int(counts[i]) + 3) // 3  # 3 w - 3 items, 1 for one word
            yield words, log_score(words, totals[ends[i] - counts[i]:ends[i]] - own[place], n_all)

    found = with_totals(docs, text_col, ngram_items, results, "n_words long, log_micro long",
                        items_per_byte=0.3, chunk_bytes=CHUNK_BYTES)
    return (docs.select(F.col(id_col), text_digest(F.col(text_col)).alias("digest"))
            .join(found, "digest", "left")
            .select(id_col, F.coalesce("n_words", F.lit(0)).alias("n_words"),
                    F.coalesce("log_micro", F.lit(0)).alias("log_micro"),
                    F.when(F.col("n_words") > 0, F.col("log_micro") / F.col("n_words") / 1e6).alias("mean_log")))
