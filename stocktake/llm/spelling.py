"""Groups of spelling variants: words one edit apart, found by products of letter counts.

Words are counted in Spark. Each then has a vector of letter counts. One inserted
or deleted letter puts the vectors of two words at a squared distance of 1, one
replaced letter at 2, and nothing else that is one edit gives less or more. All
words of a block have one length, so pairs are sought in a block and in the
blocks of the next length. Blocks are made finer, without loss, by the same rule:
letters are dealt into classes, a block holds the words with the same number of
letters of every class, and an edit adds one to a class (the length grows) or
moves one from a class to another. A block thus meets itself and the few
blocks that are one such step away.

A task holds at most ``PART_WORDS`` words of one block and multiplies their matrix
with those of the words that meet them, as many at a time (Gram matrices, in
NumPy). Pairs with a squared distance of at most 2 are compared letter by letter.
A larger block is several parts, and each pair of parts meets in a task of its own.

Defined results: a NULL text has no words; a text counts as often as its row is
repeated; a row without id is treated as of the empty id. Texts are read whole,
long ones word by word. Of near words with equal counts the smallest in
code-point order is taken. Without words the result is empty; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.common import cut_lineage, mix64

#: Words that a matrix of a task has at most.
PART_WORDS = 2048
#: Distinct words that a counting task holds before it passes them on.
HELD_WORDS = 200_000
#: Letters: a to z, then the 64 from U+00C0 on.
N_LETTERS = 26 + 64
#: Words are taken from texts of more characters one at a time.
LONG_TEXT = 1 << 20


def word_counts(docs: DataFrame, min_letters: int, min_count: int, spoil: Callable[[str], Callable[[str], str]] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: runs of letters, lower-cased in A-Z, of enough letters and occurrences.

    ``spoil``, given a row's id as text, gives a function that replaces a run by
    another, not longer one.
    """
    def run(batches):
        runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_letters)
        held: Counter[str] = Counter()

        def passed_on():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                lowered = text.as_py().encode().lower().decode()
                found = Counter(runs.findall(lowered) if len(lowered) <= LONG_TEXT else (m[0] for m in runs.finditer(lowered)))
                if spoil is None:
                    held.update(found)
                else:
                    spoiled = spoil(doc_id.as_py() or "")
                    for word, n in found.items():
                        word = spoiled(word)
                        if len(word) >= min_letters:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield passed_on()
        yield passed_on()

    return (docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# --- letters ------------------------------------------------------------------

def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers of all words in a row, and the words' lengths."""
    data = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16).astype(np.int64)
    return np.where(data < 0xC0, data - ord("a"), data - 0xC0 + 26), np.array([len(w) for w in words], np.int64)


def steps(classes: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit weight for each class, and the sums by which a block's key differs from those of its later neighbours."""
    weight = mix64(np.arange(1, classes + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        i, j = np.triu_indices(classes, 1)
        return weight, np.concatenate([weight, weight[i] - weight[j]])


def keyed(words: DataFrame, classes: int) -> DataFrame:
    """Words with the key of their block: the weighted sum of their class counts."""
    weight, _ = steps(classes)
    by_letter = weight[np.arange(N_LETTERS) % classes]

    def run(batches):
        for batch in batches:
            of, lengths = letters(batch.column(0).to_pylist())
            sums = np.concatenate([[np.uint64(0)], np.cumsum(by_letter[of], dtype=np.uint64)])
            ends = np.cumsum(lengths)
            key = (sums[ends] - sums[ends - lengths]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long")


def packed(words: DataFrame, classes: int) -> DataFrame:
    """One row per part of a block: key, part, words (joined by a space), counts, and the keys of its later neighbours."""
    _, ahead = steps(classes)
    schema = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("words", pa.string()), ("counts", pa.list_(pa.int64())),
                        ("ahead", pa.list_(pa.int64()))])

    def run(batches):
        key, part, held, counts = None, 0, [], []

        def row():
            with np.errstate(over="ignore"):
                to = (np.array([key]).view(np.uint64) + ahead).view(np.int64)
            return {"key": key, "part": part, "words": " ".join(held), "counts": counts, "ahead": to.tolist()}

        for batch in batches:
            done = []
            for k, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key or len(held) == PART_WORDS:
                    if held:
                        done.append(row())
                    part = part + 1 if k == key else 0
                    key, held, counts = k, [], []
                held.append(word)
                counts.append(n)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist([row()], schema=schema)

    return (keyed(words, classes).repartition("key").sortWithinPartitions("key", "word")
            .mapInArrow(run, "key long, part int, words string, counts array<long>, ahead array<long>"))


# --- products -----------------------------------------------------------------

class Block:
    """Words of one length: letters, letter counts and squared norms."""

    def __init__(self, words: list[str], counts: list[int], length: int):
        at = [i for i, w in enumerate(words) if len(w) == length]
        self.words, self.counts = [words[i] for i in at], [counts[i] for i in at]
        of, _ = letters(self.words)
        self.letters = of.reshape(len(at), length).astype(np.uint8)
        kind = np.float32 if length < 2048 else np.float64  # products stay exact
        place = np.repeat(np.arange(len(at)), length) * N_LETTERS + of
        self.vectors = np.bincount(place, minlength=len(at) * N_LETTERS).reshape(len(at), N_LETTERS).astype(kind)
        self.norms = (self.vectors * self.vectors).sum(axis=1)

    def close(self, other: Block, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs of words with a squared distance of ``most``."""
        kind = np.result_type(self.vectors, other.vectors)
        gram = self.vectors.astype(kind) @ other.vectors.T.astype(kind)
        return np.nonzero(self.norms[:, None] + other.norms[None, :] - 2 * gram == most)


def replaced(a: Block, b: Block, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words of one length that differ in one letter; with ``same``, a is b and a pair comes once."""
    i, j = a.close(b, 2)
    if same:
        i, j = i[i < j], j[i < j]
    good = (a.letters[i] != b.letters[j]).sum(axis=1) == 1
    return i[good], j[good]


def inserted(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs where a word of ``a`` is one of ``b``, a letter shorter, with a letter inserted."""
    i, j = a.close(b, 1)
    x, y = a.letters[i], b.letters[j]
    differs = x[:, :-1] != y
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), y.shape[1])
    good = ~((x[:, 1:] != y) & (np.arange(y.shape[1]) >= first[:, None])).any(axis=1)
    return i[good], j[good]


def near_pairs(words: DataFrame, classes: int) -> DataFrame:
    """word, n_near and best (count, negative, and word of the near word that comes first), of words with near words."""
    parts = cut_lineage(packed(words, classes))
    sizes = parts.groupBy("key").agg(F.count("*").cast("int").alias("parts"))
    host = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("host")
    guests = (parts.select(F.explode("ahead").alias("key"), "words", "counts").join(sizes, "key")
              .select("key", host, F.lit(1).alias("side"), "words", "counts"))
    own = (parts.select("key", F.explode(F.sequence(F.lit(0), F.col("part"))).alias("host"), "part", "words", "counts")
           .select("key", "host", F.when(F.col("host") == F.col("part"), 0).otherwise(1).alias("side"), "words", "counts"))

    def run(batches):
        found: dict[str, list] = {}

        def note(word, n, other):
            seen = found.setdefault(word, [0, (-n, other)])
            seen[0] += 1
            seen[1] = min(seen[1], (-n, other))

        def note_all(a, b, pairs):
            for i, j in zip(*(x.tolist() for x in pairs)):
                note(a.words[i], b.counts[j], b.words[j])
                note(b.words[j], a.counts[i], a.words[i])

        def meet(blocks, words, counts):
            for length, a in blocks.items():
                note_all(a, b := Block(words, counts, length), replaced(a, b))
                note_all(a, b := Block(words, counts, length - 1), inserted(a, b))

        def passed_on():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array([s[0] for s in found.values()], pa.int64()),
                 pa.array([s[1][0] for s in found.values()], pa.int64()), pa.array([s[1][1] for s in found.values()], pa.string())],
                names=["word", "n_near", "n", "other"])
            found.clear()
            return out

        blocks, words, counts = {}, [], []
        for batch in batches:
            for side, text, ns in zip(*(batch.column(c) for c in ("side", "words", "counts"))):
                if side.as_py() == 0 or len(words) >= PART_WORDS:
                    if words:
                        meet(blocks, words, counts)
                    words, counts = [], []
                if side.as_py() == 0:
                    here, theirs = text.as_py().split(" "), ns.as_py()
                    blocks = {length: Block(here, theirs, length) for length in sorted({len(w) for w in here})}
                    for a in blocks.values():
                        note_all(a, a, replaced(a, a, same=True))
                else:
                    words += text.as_py().split(" ")
                    counts += ns.as_py()
            if len(found) >= HELD_WORDS // 4:
                yield passed_on()
        if words:
            meet(blocks, words, counts)
        yield passed_on()

    # In each task a part comes first, then all that meet it.
    tasks = own.unionByName(guests).repartition("key", "host").sortWithinPartitions("key", "host", "side")
    return (tasks.mapInArrow(run, "word string, n_near long, n long, other string").groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(F.struct("n", "other")).alias("best")))


def followed(links: DataFrame) -> DataFrame:
    """word and root, the end of the chain that begins with the link (word, form); chains are without cycles."""
    at = cut_lineage(links.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")))
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n for each of ``words`` (word, n), unique and of letters.

    A word's form is its near word of largest n, if that is at least ``ratio``
    times the word's own; its root is where its forms lead.
    """
    words = cut_lineage(words.select("word", "n"))
    classes = max(2, words.count().bit_length() // 3)
    near = near_pairs(words, classes)
    form_n = -F.col("best.n")
    formed = form_n >= ratio * F.col("n")
    known = cut_lineage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, F.col("best.other")).alias("form"), F.when(formed, form_n).alias("form_n")))
    roots = followed(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
