"""Language identification of mixed text: script candidates, word scores, Viterbi.

A word is a run of letters (and marks) of one script. The script decides which
languages come into question: those with at least ``MIN_SHARE`` of their learned
letters in it. Within them a word scores by the smoothed log-probabilities of its
letter pairs and triples, held within ``CLIP`` of the best. Over the words of a text a
Viterbi path picks a language per word with a penalty for every switch; runs
of one language are the labelled spans. The document's language is that with the most
letters; its score is this share of letters times the language's posterior.

Most texts need no path search: if no run of words gains more than the penalty by
leaving the best single language, that language is the best path. This is decided
for whole blocks by a running maximum.

Learned from a sample of at most about ``sample_rows`` rows per language, drawn by
a hash of the id; the model is a table of 2**BITS buckets per language.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0, as
is every text if nothing could be learned. Letters of a script that no language
uses score nothing. Languages that tie go by name; repeated rows each get their
result; other columns are ignored, whatever their names. A text is one block in memory,
of some hundred times its bytes with eight languages.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.common import arrow_text, row_blocks

BITS = 16
CLIP = 6.0
SWITCH = 14.0
MIN_SHARE = 0.01
SAMPLE_ROWS = 3000

# First and last code point of the letters of common scripts.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER, SHARED = len(SCRIPTS) + 1, len(SCRIPTS) + 2
POINTS = 0x32400


def letter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: script number (0: no part of a word), is it a letter, its lower case."""
    script = np.zeros(POINTS, np.uint8)
    letter = np.zeros(POINTS, bool)
    lower = np.arange(POINTS, dtype=np.uint32)
    for point in range(POINTS):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LM":
            script[point] = OTHER if kind == "L" else SHARED
            letter[point] = kind == "L"
            small = chr(point).lower()
            if len(small) == 1 and ord(small) < POINTS:
                lower[point] = ord(small)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            part = script[first:last + 1]
            part[part == OTHER] = number
    return script, letter, lower


def words_and_grams(data: np.ndarray, offsets: np.ndarray, tables):
    """Per word: script, start, end (code points within the block), text; and its letters' grams.

    Returns (script, start, end, text_of_word, gram_starts, pairs, triples,
    point_offsets): gram arrays have one entry per word character.
    """
    script_of, letter_of, lower_of = tables
    n = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    point_at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    if point_at[-1] != len(points):
        raise ValueError("text is not UTF-8")
    points = np.minimum(points, POINTS - 1)
    script = script_of[points]
    text = np.repeat(np.arange(n, dtype=np.int32), np.diff(point_at))
    at = np.flatnonzero(script)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty, empty, empty, point_at
    # Marks shared by scripts belong to the letter before them.
    own = script[at]
    source = np.maximum.accumulate(np.where(own != SHARED, np.arange(len(at)), 0))
    own = own[source]
    start = np.ones(len(at), bool)
    start[1:] = (np.diff(at) > 1) | (own[1:] != own[:-1]) | (text[at[1:]] != text[at[:-1]])
    end = np.append(start[1:], True)
    small = lower_of[points[at]]
    before = np.where(start, np.uint32(0), np.concatenate([[np.uint32(0)], small[:-1]]))
    after = np.where(end, np.uint32(0), np.append(small[1:], np.uint32(0)))
    pairs = (before * np.uint32(2654435761)) ^ (small * np.uint32(2246822519))
    triples = pairs ^ (after * np.uint32(3266489917)) ^ np.uint32(0x9E3779B9)
    pairs, triples = (((h ^ h >> np.uint32(15)) * np.uint32(668265263)) >> np.uint32(32 - BITS) for h in (pairs, triples))
    first = np.flatnonzero(start)
    # A run of marks alone is no word.
    last = np.flatnonzero(end)
    has_letter = np.logical_or.reduceat(letter_of[points[at]], first)
    script = np.where(has_letter, own[first], 0)
    return script, at[first], at[last] + 1, text[at[first]], first, pairs, triples, point_at


def best_path(scores: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi path over the words of a text (rows) and the languages (columns)."""
    n, width = scores.shape
    came = np.zeros((n, width), np.int32)
    state = scores[0].copy()
    stay = np.arange(width)
    for i in range(1, n):
        best = int(state.argmax())
        jump = state[best] - switch
        moved = state < jump
        came[i] = np.where(moved, best, stay)
        state = np.where(moved, jump, state) + scores[i]
    path = np.zeros(n, np.int32)
    path[-1] = int(state.argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = came[i, path[i]]
    return path


def fit(docs: DataFrame, learn_from: Column, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> dict:
    """Gram and script counts per language, from rows that ``learn_from`` (over the id) admits."""
    tables = letter_tables()
    known = (docs.select(F.col(id_col), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
             .where(F.col("lang").isNotNull() & F.col(id_col).isNotNull() & learn_from))
    rows = known.groupBy("lang").count().collect()  # one row per language
    langs = sorted(r["lang"] for r in rows)
    if not langs:
        return {"langs": [], "tables": tables}
    rate = F.create_map(*[F.lit(x) for r in rows for x in (r["lang"], int(min(1.0, sample_rows / r["count"]) * (1 << 30)))])
    drawn = known.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30)) < rate[F.col("lang")])
    number = {lang: i for i, lang in enumerate(langs)}

    def run(batches):
        grams = np.zeros((len(langs), 1 << BITS), np.int64)
        letters = np.zeros((len(langs), SHARED + 1), np.int64)
        for batch in batches:
            data, offsets = arrow_text(batch.column(0))
            own = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for low, high in row_blocks(offsets):
                script, start, end, text, first, pairs, triples, _ = words_and_grams(
                    data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], tables)
                lang = own[low:high][text.astype(np.int64)]
                for i in np.unique(lang):
                    mine = lang == i
                    letters[i] += np.bincount(script[mine], weights=(end - start)[mine], minlength=SHARED + 1).astype(np.int64)
                    of = np.repeat(mine, np.diff(np.append(first, len(pairs))))
                    grams[i] += np.bincount(pairs[of], minlength=1 << BITS)
                    grams[i] += np.bincount(triples[of], minlength=1 << BITS)
        for i in range(len(langs)):
            for kind, counts in ((0, letters[i]), (1, grams[i])):
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), i)), pa.array(np.full(len(at), kind)), pa.array(at), pa.array(counts[at])],
                    names=["lang", "kind", "at", "n"])

    counted = (drawn.select("text", "lang").mapInArrow(run, "lang long, kind long, at long, n long")
               .groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toArrow())
    lang, kind, at, n = (counted.column(c).to_numpy() for c in ("lang", "kind", "at", "n"))
    grams, letters = np.zeros((1 << BITS, len(langs))), np.zeros((SHARED + 1, len(langs)))
    for out, k in ((letters, 0), (grams, 1)):
        out[at[kind == k], lang[kind == k]] = n[kind == k]
    weights = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * (1 << BITS))).astype(np.float32)
    return {"langs": langs, "tables": tables, "weights": weights,
            "candidates": letters >= MIN_SHARE * np.maximum(letters.sum(axis=0), 1)}


def label_block(data: np.ndarray, offsets: np.ndarray, model: dict, shortcut: bool = True):
    """Per text: language, score, spans (language, first and last + 1 code point).

    With the ``shortcut`` only texts that may have several spans are searched for a path.
    """
    langs = model["langs"]
    n = len(offsets) - 1
    script, start, end, text, first, pairs, triples, point_at = words_and_grams(data, offsets, model["tables"])
    real = np.flatnonzero(script)
    if not len(real) or not langs:
        return [("und", 0.0, [])] * n
    weights = model["weights"]
    scores = np.add.reduceat(weights[pairs] + weights[triples], first, axis=0)[real]
    script, start, end, text = script[real], start[real], end[real], text[real]
    open_ = model["candidates"][script]
    some = open_.any(axis=1, keepdims=True)
    scores = np.where(open_, scores, -np.inf)
    scores = np.where(some, np.maximum(scores - np.where(some, scores, 0).max(axis=1, keepdims=True), -CLIP), 0).astype(np.float64)
    at = np.searchsorted(text, np.arange(n + 1))
    used = np.flatnonzero(np.diff(at))
    total = np.add.reduceat(scores, at[used], axis=0)
    best = total.argmax(axis=1)
    words_in = np.diff(at)[used]
    simple = np.ones(len(used), bool)
    if not shortcut:
        simple[:] = False
    elif len(langs) > 1:
        # The largest gain of any run of words by leaving the best single language; texts
        # follow each other with a drop between them that no gain makes up for.
        mine = np.repeat(best, words_in)
        row = np.arange(len(scores))
        kept = scores[row, mine]
        scores[row, mine] = -np.inf
        gain = scores.max(axis=1) - kept
        scores[row, mine] = kept
        drop = np.repeat(np.arange(len(used)), words_in) * (2 * CLIP * (words_in.max() + 1))
        sums = np.concatenate([[0.0], np.cumsum(gain)])
        lowest = np.minimum.accumulate(sums[:-1] - drop)
        simple = np.maximum.reduceat(sums[1:] - drop - lowest, at[used]) <= SWITCH
    out = [("und", 0.0, [])] * n
    letters = end - start
    for j, i in enumerate(used):
        a, b, base = at[i], at[i + 1], point_at[i]
        odds = np.exp(total[j] - total[j].max())
        if simple[j]:
            out[i] = (langs[best[j]], float(odds[best[j]] / odds.sum()), [(langs[best[j]], int(start[a] - base), int(end[b - 1] - base))])
            continue
        path = best_path(scores[a:b], SWITCH)
        share = np.bincount(path, weights=letters[a:b], minlength=len(langs))
        top = int(share.argmax())
        cut = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
        ends = np.append(cut[1:], b - a) - 1
        spans = [(langs[path[s]], int(start[a + s] - base), int(end[a + e] - base)) for s, e in zip(cut, ends)]
        mine = path == top
        odds = scores[a:b][mine].sum(axis=0)
        odds = np.exp(odds - odds.max())
        out[i] = (langs[top], float(share[top] / share.sum() * odds[top] / odds.sum()), spans)
    return out


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, spans) of every row; spans are in code points."""
    kind = docs.schema[id_col].dataType.simpleString()
    spans = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            data, offsets = arrow_text(batch.column(1))
            found = []
            for low, high in row_blocks(offsets):
                found += label_block(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], model)
            lang, score, parts = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array([[{"lang": x, "start": a, "end": b} for x, a, b in p] for p in parts], spans)],
                names=[id_col, "lang_pred", "score", "spans"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, spans array<struct<lang: string, start: bigint, end: bigint>>")
