"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import inspect
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.session import scratch_path

#: A word of the contracts: a run without space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that one numpy block works on; a longer document forms a block alone.
BLOCK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that one task makes of a narrow table whose size is known to be small.
TASK_ROWS = 1 << 17


def in_tasks(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df``, of at most ``rows`` rows, in no more partitions than a task for each ``task_rows`` of them."""
    return df.coalesce(max(1, -(-rows // task_rows)))


def cut_lineage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder of the session and go on from the files.

    Unlike a checkpoint, a written table has its true size, so an iteration's
    joins are planned from what is left, not from a product of old estimates.
    With ``rows``, which it has at most, a small table is not strewn over a file per
    shuffle partition: on a local file system an executor starts six processes
    to write one.
    """
    if rows is not None:
        df = in_tasks(df, rows)
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of the filter below, as words of 64: a table of at most so many rows.
FILTER_WORDS = 1 << 17


def _filter_place(id_col: Column) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(64 * FILTER_WORDS))


def split_by_ids(rows: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may be among ``ids`` (one column) and rows that surely are not.

    A bitmap of the hashed ids, a broadcast table of at most ``FILTER_WORDS``
    small rows, sorts out the others in place, so only the first part need be
    shuffled for an exact join. With very many ids it sorts out less and less.
    """
    place = _filter_place(F.col(id_col))
    bits = (ids.select(_filter_place(F.col(ids.columns[0])).alias("p"))
            .groupBy(F.shiftright("p", 6).alias("__word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("__mask")))
    marked = rows.withColumn("__word", F.shiftright(place, 6)).withColumn("__bit", (place % 64).cast("int"))
    bits = F.broadcast(bits.withColumnRenamed("__word", "__held"))
    hit = (F.col("__word") == F.col("__held")) & (F.getbit("__mask", "__bit") == 1)
    return tuple(marked.join(bits, hit, how).drop("__word", "__bit") for how in ("left_semi", "left_anti"))


#: Keys that fewer rows share than this need no care in a join.
UNEVEN_ROWS = 256
#: A key with more than one in so many rows is joined by broadcast: there are fewer such keys than this.
UNEVEN_SHARE = 2000


def join_uneven(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` left-joined to ``keyed``, unique by ``keys``, of whose keys some may have very many rows.

    ``weight`` is a column of ``keyed`` that is no less than a key's rows and is
    left out. Keys with more than a ``UNEVEN_SHARE``-th of its sum, fewer than
    ``UNEVEN_SHARE`` of them, are joined where the rows are.
    """
    total, most = keyed.agg(F.sum(weight), F.max(weight)).first()
    limit = max(UNEVEN_ROWS, (total or 0) // UNEVEN_SHARE)
    if (most or 0) <= limit:
        return rows.join(keyed.drop(weight), keys, "left")
    heavy = F.broadcast(keyed.where(F.col(weight) > limit).drop(weight))
    light = keyed.where(F.col(weight) <= limit).drop(weight)
    return (rows.join(heavy, keys).unionByName(
        rows.join(heavy.select(*keys), keys, "left_anti").join(light, keys, "left")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def id_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (NULL for a NULL id)."""
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(n))


def give_back() -> None:
    """Freed memory goes back to the system: Arrow's and, where it can be told, the C library's."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim is not None:
            trim(0)


def tidied(fn: Callable) -> Callable:
    """``fn`` for Python workers, whose memory is given back between tasks.

    A worker lives on from task to task, and every task brings its functions anew,
    with the tables that they fill. The old ones refer to each other, so nothing
    drops them but a collection, one per task; Arrow's pool and the C library keep
    what is freed until they are told.
    """
    fresh = [True]

    def begin() -> None:
        if fresh:
            fresh.clear()
            gc.collect()
        give_back()

    def stream(batches):
        begin()
        for out in fn(batches):
            yield out
            pa.default_memory_pool().release_unused()
        give_back()

    def group(rows):
        begin()
        return fn(rows)

    def two_groups(left, right):
        begin()
        return fn(left, right)

    return stream if inspect.isgeneratorfunction(fn) else two_groups if len(inspect.signature(fn).parameters) == 2 else group


# --- text as byte arrays -----------------------------------------------------

def arrow_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; NULL has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if len(at) == 0:
        at = np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have about ``limit`` bytes, one row at least."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (a fixed bijection)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


#: A random 64-bit value for each byte, the same in every process.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x2545F4914F6CDD1D
_POWERS: dict[int, list[np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, modulo 2**64, for i < n."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(b, len(p), 1 << 64))])
            out.append(p[:size])
        if size > 1 << 23:  # a very long text: not worth keeping
            return out[0][:n], out[1][:n]
        _POWERS[base] = out
    return _POWERS[base][0][:n], _POWERS[base][1][:n]


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of each slice values[start:end]."""
    p, inverse = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[:len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_bounds(data: np.ndarray, offsets: np.ndarray,
                gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 word offsets of the n texts.

    ``gap`` marks the bytes that belong to no word.
    """
    inside = ~gap[data]
    first = np.ones(len(data) + 1, bool)  # is the byte before this one no part of the same word
    first[1:] = ~np.append(inside[:-1], False) if len(data) else True
    first[offsets] = True
    starts = np.flatnonzero(inside & first[:-1])
    last = np.ones(len(data), bool)
    if len(data):
        last[:-1] = ~inside[1:] | first[1:-1]
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts, and the word offsets of the texts."""
    starts, ends, at = word_bounds(data, offsets)
    return hash_spans(data, starts, ends), at


#: Text bytes that are hashed at once: their values have eight bytes each.
HASH_BYTES = 1 << 22


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans follow each other.

    A very long text is hashed some megabytes at a time.
    """
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + HASH_BYTES, side="right")))
        base = starts[low]
        values = BYTE_VALUE[data[base:ends[high - 1]]]
        out[low:high] = rolling(values, starts[low:high] - base, ends[low:high] - base)
        low = high
    return mix64(out + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words within one text, and the word it starts at."""
    counts = np.maximum(np.diff(at) - n + 1, 0)
    starts = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return mix64(rolling(words, starts, starts + n, BASE ^ (n << 8))), starts

