"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A text is split by a pattern into pieces, each encoded alone. A piece starts as
its single bytes. A segment tree over the byte positions holds, at the leaf of
every live token's first byte, the rank of its pair with the next live token, and in every
node the smallest rank below; descending to the left child when it holds the
minimum finds the leftmost. A merge joins the two tokens, takes the right one out of
the list of live neighbours, and updates the leaves of the merged token, of the
one taken out and of the one before: three paths to the root. The ranks give the ids, as with the public
library for rank files; a piece that is itself a token is that token.

Distinct short pieces of a block of texts are encoded together, one tree per row
of a matrix, so a round does a merge in every piece at once; a long piece has a
tree of its own. Pieces met before come from a memory of ``MEMORY`` entries per
task, emptied when full: it saves work only.

A text is read in runs of pieces, so a very long one needs memory for itself and
its ids, not for a list of its pieces.

Defined results: a NULL text counts as empty, with no ids; decoding joins the
tokens' bytes and, as text, replaces bytes that are no UTF-8. Repeated rows each get
their result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stocktake.llm.common import tidied

NO_RANK = np.int32(np.iinfo(np.int32).max)
#: Pieces of up to so many bytes are encoded in blocks.
SHORT = 64
MEMORY = 60_000
#: Pieces of one text that are held at a time.
RUN = 50_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes from a rank file, whose lines hold a base64 token and its rank.

    The file is the driver's; the ranks travel with the tasks.
    """
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Vocabulary:
    """Ids, bytes and merges of a rank file; a merge's rank is its result's id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, i in ranks.items():
            self.tokens[i] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = i
        self.pairs = pairs
        # The same as an open-addressed table: slot of a key, key, rank.
        self.bits = max(4, (4 * len(pairs)).bit_length())
        keys = np.full(1 << self.bits, -1, np.int64)
        values = np.full(1 << self.bits, NO_RANK, np.int32)
        todo = np.fromiter(pairs, np.int64, len(pairs))
        ranked = np.fromiter(pairs.values(), np.int32, len(pairs))
        step = 0
        while len(todo):
            slot = self._slot(todo, step)
            free = keys[slot] == -1
            keys[slot[free]] = todo[free]  # of several keys for a slot, one stays
            placed = keys[slot] == todo
            values[slot[placed]] = ranked[placed]
            todo, ranked = todo[~placed], ranked[~placed]
            step += 1
        self.keys, self.values, self.probes = keys, values, step

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NO_RANK where a side is missing (negative) or the pair is no token."""
        key = left * self.size + right
        key[(left < 0) | (right < 0)] = -2
        out = np.full(len(key), NO_RANK, np.int32)
        todo = np.arange(len(key))
        for step in range(self.probes):
            slot = self._slot(key[todo], step)
            held = self.keys[slot]
            hit = held == key[todo]
            out[todo[hit]] = self.values[slot[hit]]
            todo = todo[~hit & (held != -1)]
            if not len(todo):
                break
        return out


def encode_long(piece: bytes, vocab: Vocabulary) -> list[int]:
    """Ids of one piece, with a tree of its own."""
    n, pairs, size = len(piece), vocab.pairs, vocab.size
    ids = vocab.of_byte[np.frombuffer(piece, np.uint8)].tolist()
    none = int(NO_RANK)
    width = 1 << max(0, n - 1).bit_length()
    tree = [none] * (2 * width)
    for i in range(n - 1):
        tree[width + i] = pairs.get(ids[i] * size + ids[i + 1], none)
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def put(at: int, rank: int) -> None:
        at += width
        tree[at] = rank
        at >>= 1
        while at:
            low = min(tree[2 * at], tree[2 * at + 1])
            if tree[at] == low:
                break
            tree[at] = low
            at >>= 1

    while tree[1] != none:
        at = 1
        while at < width:
            at = 2 * at if tree[2 * at] == tree[1] else 2 * at + 1
        at -= width
        gone = after[at]
        ids[at] = tree[1]
        ids[gone] = -1
        right = after[at] = after[gone]
        if right < n:
            before[right] = at
        put(gone, none)
        put(at, pairs.get(ids[at] * size + ids[right], none) if right < n else none)
        left = before[at]
        if left >= 0:
            put(left, pairs.get(ids[left] * size + ids[at], none))
    return [i for i in ids if i >= 0]


def encode_block(pieces: list[bytes], vocab: Vocabulary) -> np.ndarray:
    """Ids of short pieces, a row each in the order of the bytes; -1 where a byte starts no token."""
    width = 1 << max(0, max(map(len, pieces)) - 1).bit_length()
    n = len(pieces)
    lengths = np.array([len(p) for p in pieces])
    ids = np.full((n, width + 1), -1, np.int64)  # the last column is the missing neighbour
    inside = np.arange(width) < lengths[:, None]
    ids[:, :width][inside] = vocab.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    tree = np.full((n, 2 * width), NO_RANK, np.int32)
    tree[:, width:] = vocab.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
    for level in range(width.bit_length() - 2, -1, -1):
        a = 1 << level
        tree[:, a:2 * a] = np.minimum(tree[:, 2 * a:4 * a:2], tree[:, 2 * a + 1:4 * a:2])
    after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
    after[np.arange(n), np.maximum(lengths - 1, 0)] = width
    before = np.tile(np.arange(-1, width), (n, 1))
    before[:, 0] = width  # none: the missing neighbour too

    def put(rows: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
        at = at + width
        tree[rows, at] = rank
        while width > 1 and at[0] > 1:
            at = at >> 1
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

    while True:
        rows = np.flatnonzero(tree[:, 1] != NO_RANK) if width > 1 else np.zeros(0, int)
        if not len(rows):
            return ids[:, :width]
        least = tree[rows, 1]
        at = np.ones(len(rows), np.int64)
        for _ in range(width.bit_length() - 1):
            at = 2 * at + (tree[rows, 2 * at] != least)
        at -= width
        gone = after[rows, at]
        right = after[rows, gone]
        ids[rows, at], ids[rows, gone] = least, -1
        after[rows, at] = right
        before[rows, right] = at
        left = before[rows, at]
        put(rows, gone, np.full(len(rows), NO_RANK, np.int32))
        put(rows, at, vocab.rank_of(least.astype(np.int64), ids[rows, right]))
        some = left < width
        if some.any():
            put(rows[some], left[some], vocab.rank_of(ids[rows[some], left[some]], least[some].astype(np.int64)))


class Encoder:
    """Splits and encodes texts; remembers the ids of pieces."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.split = vocab, regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        """Adds the ids of new pieces, as little-endian 32-bit numbers."""
        if len(self.known) > MEMORY:
            self.known = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            body = piece.encode("utf-8", "replace")
            whole = self.vocab.ranks.get(body)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(body) > SHORT:
                self.known[piece] = np.array(encode_long(body, self.vocab), "<u4").tobytes()
            else:
                by_width.setdefault(max(0, len(body) - 1).bit_length(), []).append((piece, body))
        for group in by_width.values():
            for low in range(0, len(group), 8192):
                part = group[low:low + 8192]
                ids = encode_block([body for _, body in part], self.vocab)
                live = ids >= 0
                packed = ids[live].astype("<u4").tobytes()
                ends = (np.cumsum(live.sum(axis=1)) * 4).tolist()
                for (piece, _), a, b in zip(part, [0, *ends], ends):
                    self.known[piece] = packed[a:b]

    def encode(self, texts: list[str]):
        """Ids of each text, as bytes of little-endian 32-bit numbers."""
        out = []
        low = 0
        while low < len(texts):  # texts of about a run of pieces together
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= RUN * 8):
                size += len(texts[high])
                high += 1
            if high == low + 1:
                found, pieces = [], (m.group() for m in self.split.finditer(texts[low]))
                while run := list(islice(pieces, RUN)):
                    found.append(self._ids(run, [len(run)])[0])
                out.append(b"".join(found))
            else:
                runs = [self.split.findall(t) for t in texts[low:high]]
                out += self._ids([p for r in runs for p in r], [len(r) for r in runs])
            low = high
        return out

    def _ids(self, pieces: list[str], counts: list[int]) -> list[bytes]:
        new = set(pieces) - self.known.keys()
        if new:
            if len(self.known) > MEMORY:
                new = set(pieces)
            self._learn(new)
        at, out = 0, []
        for n in counts:
            out.append(b"".join(map(self.known.__getitem__, pieces[at:at + n])))
            at += n
        return out


def decode(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.tokens.__getitem__, ids.tolist()))


def tokenize(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
             ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, with the ids themselves if asked for.

    The digests are over the ids as little-endian 32-bit numbers and over the
    bytes decoded from them.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids"]

    def run(batches):
        vocab = Vocabulary(ranks)
        encoder = Encoder(vocab, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                packed = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                numbers = [np.frombuffer(p, "<u4") for p in packed]
                columns = [part.column(0), pa.array([len(x) for x in numbers], pa.int64()),
                           pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                           pa.array([hashlib.sha256(decode(x, vocab)).hexdigest() for x in numbers], pa.string())]
                if ids:
                    columns.append(pa.array([x.astype(np.int32) for x in numbers], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names[:len(columns)])

    return docs.select(id_col, text_col).mapInArrow(tidied(run), schema)


def detokenize(rows: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from ids; NULL ids give a NULL text."""
    kind = rows.schema[id_col].dataType.simpleString()
    tokens = {i: t for t, i in ranks.items()}

    def run(batches):
        for batch in batches:
            texts = [None if x is None else b"".join(tokens[i] for i in x).decode("utf-8", "replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return rows.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")
