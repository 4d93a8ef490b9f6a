"""Remove passages that repeat: every window of ``n`` words that occurs twice.

Every window of ``n`` consecutive words of one document gets a Rabin-Karp hash.
The hashes are counted over all documents, copies of whole texts included, by
``chunks``; windows with a count of two or more merge into maximal intervals, and
their words are removed. Windows are judged on the input.

Hashes have 64 bits; among w windows about w * w / 2**65 pairs collide, 0.7 for 5e9.
A second hash of 16 bits tells them apart: windows of several chunks are
repeated only if all that share the first hash share the second.

Defined results: a NULL text has no words and stays NULL; a text with fewer words than a window
loses none; white space between kept words stays as it was, removed intervals
leave one space; rows that repeat, even wholly, count as separate occurrences. A
text is one block in memory, of some 40 times its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.chunks import text_digest, with_totals
from stocktake.llm.common import mix64, window_hashes, word_bounds, word_hashes

CHUNK_BYTES = 3 << 20


def removed_words(repeated: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """Marks the words that a repeated window covers; ``repeated`` is by window start."""
    steps = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(repeated)
    steps[at] += 1
    steps[at + n] -= 1
    return np.cumsum(steps[:-1]) > 0


def without(text: bytes, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> bytes:
    """The text without the marked words; unchanged if none is."""
    if not gone.any():
        return text
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
    return b" ".join(text[starts[a]:ends[b - 1]] for a, b in zip(edge[::2], edge[1::2]))


def dedup_substrings(docs: DataFrame, n: int = 50, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with n_words, n_removed, kept_sha256 and kept_text.

    ``kept_sha256`` is over the kept words joined by one space. A column of
    ``docs`` with one of these names is replaced.
    """
    def windows(data, offsets):
        words, at = word_hashes(data, offsets)
        second = window_hashes(mix64(words + np.uint64(n)), at, n)[0]
        return window_hashes(words, at, n)[0], np.maximum(np.diff(at) - n + 1, 0), second

    def results(data, offsets, copies, counts, totals):
        ends_of = np.cumsum(counts)
        for i in range(len(copies)):
            text = data[offsets[i]:offsets[i + 1]]
            starts, ends, _ = word_bounds(text, np.array([0, len(text)]))
            gone = removed_words(totals[ends_of[i] - counts[i]:ends_of[i]] > 1, len(starts), n)
            body = text.tobytes()
            kept = without(body, starts, ends, gone)
            yield len(starts), int(gone.sum()), hashlib.sha256(b" ".join(kept.split())).hexdigest(), kept.decode()

    found = with_totals(docs, text_col, windows, results,
                        "n_words long, n_removed long, kept_sha256 string, kept_text string",
                        items_per_byte=0.16, chunk_bytes=CHUNK_BYTES)
    marked = (docs.withColumn("__digest", text_digest(F.col(text_col)))
              .drop(text_col, "n_words", "n_removed", "kept_sha256", "kept_text"))
    none = hashlib.sha256(b"").hexdigest()
    return (marked.join(found.withColumnRenamed("digest", "__digest"), "__digest", "left").drop("__digest")
            .withColumn("n_words", F.coalesce("n_words", F.lit(0)))
            .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
            .withColumn("kept_sha256", F.coalesce("kept_sha256", F.lit(none))))
