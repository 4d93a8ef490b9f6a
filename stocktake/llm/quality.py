"""Quality classifier: averaged hashed subword vectors and a softmax, trained by SGD.

Features of a text are its words, the byte 3- and 4-grams of its words (with
their edges) and pairs of neighbouring words; a pair of equal words is one feature whatever the word.
Each is hashed into ``2**BITS`` learned vectors. A document is the average of its
features' vectors; a softmax layer gives the probability of label 1. Vectors and
layer are trained together by stochastic gradient descent in numpy, in one task,
on a sample of about ``sample_rows`` labelled documents drawn by a hash of the
id. Training takes them by that hash until their features have ``sample_bytes``.

As average and layer are linear up to the softmax, scoring needs one number per
feature, its vector's projection; so a score is the logistic of an average of
table look-ups, computed over whole texts in blocks.

Defined results: a NULL text counts as empty; a text without words gets the bias
alone; with no labels every score is 1/2, and with one class all follow its
share. Labels that are NULL or have no id teach nothing. A document teaches each
of its labels once, however often labelled; of rows that share an id the
smallest text teaches. Repeated rows each get their score; a column named score is
replaced. A long text is read in slices, cut at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.llm.common import SPACE, arrow_text, mix64, row_blocks, split_by_ids, tidied, word_hashes

BITS = 17
DIM = 10
SAMPLE_ROWS = 4000
#: Bytes of a long text that are taken at once.
SLICE_BYTES = 1 << 22
#: Bytes of the sample's features (eight a distinct feature of a text) that training holds.
SAMPLE_BYTES = 1 << 27


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix64(h) >> np.uint64(64 - BITS)).astype(np.int32)


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.where(left == right, np.uint64(1), left * np.uint64(3) + right)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: buckets, and the n + 1 offsets by text."""
    words, at = word_hashes(data, offsets)
    out = [(_bucket(words), at)]
    # Pairs end at every word but the first of a text.
    inner = np.ones(len(words), bool)
    inner[at[:-1][np.diff(at) > 0]] = False
    second = np.flatnonzero(inner)
    out.append((_bucket(_pairs(words[second - 1], words[second])), np.searchsorted(second, at)))
    # White space separates words; one more in front of each text and at the end.
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    place = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), lengths)
    padded = np.full(len(data) + n + 3, 0x20, np.uint8)
    padded[place] = np.where(SPACE[data], np.uint8(0x20), data)
    gap = padded == 0x20
    start = offsets + np.arange(n + 1)
    wide = padded.astype(np.uint32)
    three = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    for size, key in ((3, three), (4, three[:-1] | wide[3:] << np.uint32(24))):
        at_gram = np.flatnonzero(~np.logical_or.reduce([gap[j:len(key) + j] for j in range(1, size - 1)]))
        h = (key[at_gram] + np.uint32(size)) * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
        h *= np.uint32(2246822519)
        out.append(((h >> np.uint32(32 - BITS)).astype(np.int32), np.searchsorted(at_gram, start)))
    return out


def slices(data: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of one text of about ``SLICE_BYTES``, cut at white space."""
    low = 0
    while low < len(data):
        high = min(len(data), low + SLICE_BYTES)
        if high < len(data):
            gap = np.flatnonzero(SPACE[data[high:high + SLICE_BYTES]])
            while not len(gap) and high + SLICE_BYTES < len(data):  # a word longer than a slice
                high += SLICE_BYTES
                gap = np.flatnonzero(SPACE[data[high:high + SLICE_BYTES]])
            high = high + int(gap[0]) if len(gap) else len(data)
        yield data[low:high]
        low = high


def long_text_total(data: np.ndarray, table: np.ndarray) -> tuple[float, int]:
    """Sum of the features' weights of one long text, and their number, slice by slice."""
    total, count, last = 0.0, 0, None
    for part in slices(data):
        ends = np.array([0, len(part)])
        words, _ = word_hashes(part, ends)
        for buckets, _ in features(part, ends):
            total += float(table[buckets].sum(dtype=np.float64))
            count += len(buckets)
        if len(words):
            if last is not None:  # the pair that the cut parts
                total += float(table[_bucket(_pairs(last, words[:1]))][0])
                count += 1
            last = words[-1:]
    return total, count


def histogram(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and their share of all its features."""
    counts, last = np.zeros(1 << BITS, np.int64), None
    for part in slices(np.frombuffer(text, np.uint8)):
        ends = np.array([0, len(part)])
        words, _ = word_hashes(part, ends)
        for found, _ in features(part, ends):
            counts += np.bincount(found, minlength=1 << BITS)
        if len(words):
            if last is not None:
                counts[_bucket(_pairs(last, words[:1]))] += 1
            last = words[-1:]
    buckets = np.flatnonzero(counts).astype(np.int32)
    return buckets, (counts[buckets] / max(1, counts.sum())).astype(np.float32)


def train_parts(rows: list[tuple[np.ndarray, np.ndarray, int]], rate: float = 4.0,
                seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, softmax layer and its bias from (buckets, shares, label) rows."""
    ones = sum(label for _, _, label in rows)
    prior = float(np.log((ones + 1) / (len(rows) - ones + 1)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    layer = np.zeros((DIM, 2), np.float32)
    bias = np.array([0.0, prior], np.float32)
    if ones in (0, len(rows)):
        return vectors, layer, bias
    epochs = max(5, min(40, 24_000 // len(rows)))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, shares, label = rows[i]
            lr = rate * (1 - done / steps)
            done += 1
            mean = shares @ vectors[buckets]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= lr * np.outer(mean, p)
            bias -= 0.02 * lr * p
            vectors[buckets] -= (lr * shares)[:, None] * back[None, :]
    return vectors, layer, bias


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Projected table and bias: each vector's part in the difference of the two classes."""
    vectors, layer, bias = train_parts(rows)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label_col: str, learn_from: Column, sample_rows: int = SAMPLE_ROWS,
        sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Train on labelled rows that ``learn_from`` (over the id) admits.

    One task of an executor trains; the driver gets the projected table alone.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isNotNull() & F.col("id").isNotNull() & learn_from).distinct())
    n = known.count()
    if not n:
        return train([])
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("sample")), F.lit(1 << 30))
    drawn = known.withColumn("draw", draw).where(F.col("draw") < int(min(1.0, sample_rows / n) * (1 << 30)))
    wanted = drawn.select("id").distinct()
    maybe, _ = split_by_ids(docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")), wanted, "id")
    texts = maybe.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    rows = texts.join(drawn, "id").select("draw", F.col("id").cast("string").alias("id"), "label", "text")

    def shares(batches):
        for batch in batches:
            pairs = [histogram(t.as_buffer().to_pybytes()) for t in batch.column(3).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([b.tobytes() for b, _ in pairs], pa.binary()),
                 pa.array([s.tobytes() for _, s in pairs], pa.binary())], names=["draw", "id", "label", "buckets", "shares"])

    def learn(batches):
        sample, size = [], 0
        for batch in batches:
            for label, b, s in zip(*(batch.column(k) for k in (2, 3, 4))):
                size += 2 * len(b.as_buffer())
                if size > sample_bytes and sample:
                    break
                sample.append((np.frombuffer(b.as_py(), np.int32), np.frombuffer(s.as_py(), np.float32), int(label.as_py() == 1)))
        table, bias = train(sample)
        yield pa.RecordBatch.from_arrays([pa.array([table.astype(np.float32).tobytes()], pa.binary()), pa.array([bias])],
                                         names=["weights", "bias"])

    model = (rows.mapInArrow(tidied(shares), "draw long, id string, label int, buckets binary, shares binary")
             .repartition(1).sortWithinPartitions("draw", "id", "label")
             .mapInArrow(tidied(learn), "weights binary, bias double").collect())
    return (np.frombuffer(bytes(model[0].weights), np.float32), model[0].bias) if model else train([])


def with_score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """``docs`` with a column score; one of that name is replaced."""
    table, bias = model
    docs = docs.drop("score")
    at_text = docs.columns.index(text_col)
    names = [*docs.columns, "score"]

    def run(batches):
        for batch in batches:
            data, offsets = arrow_text(batch.column(at_text))
            out = np.zeros(batch.num_rows)
            for low, high in row_blocks(offsets):
                if offsets[high] - offsets[low] > SLICE_BYTES:  # one long text
                    total, n = long_text_total(data[offsets[low]:offsets[high]], table)
                    out[low] = total / max(n, 1)
                    continue
                total, count = np.zeros(high - low), np.zeros(high - low)
                for buckets, at in features(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]):
                    sums = np.concatenate([[0.0], np.cumsum(table[buckets], dtype=np.float64)])
                    total += sums[at[1:]] - sums[at[:-1]]
                    count += np.diff(at)
                out[low:high] = total / np.maximum(count, 1)
            score = pa.array(1 / (1 + np.exp(-np.clip(out + bias, -60, 60))))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=names)

    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
