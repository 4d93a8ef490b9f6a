"""Spelling variants against a comparison of all pairs, and their awkward inputs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktake.llm import spelling
from stocktake.llm.queries import _one_deleted
from tests.llm.fixtures import empty, frame, rows


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), form[w] and counts[form[w]]) for w, n in counts.items()}


def vocabulary(seed, n=700):
    rng = random.Random(seed)
    letters = "abcßéÀÿ×z"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 8))) for _ in range(n)}
    for w in list(words)[:n // 2]:  # chains of edits, with counts that fall by turns
        for _ in range(3):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            if len(w) >= 6:
                words.add(w)
    return {w: rng.choice([5, 6, 25, 30, 125, 150, 700, 10**12]) for w in words}


def collected(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("part_words", [2048, 7])
def test_variants_match_all_pairs(spark, monkeypatch, part_words):
    monkeypatch.setattr(spelling, "PART_WORDS", part_words)
    counts = {**vocabulary(1), "a" * 5000: 9, "a" * 5001: 50, "a" * 4999 + "b": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.spelling_variants(df.withColumn("key", F.lit("x")).withColumn("form", F.lit("x")))
    assert got.count() == len(counts) and collected(got) == brute_force(counts)


@pytest.mark.parametrize("classes", [2, 3, 5, 9])
def test_any_number_of_classes_finds_all(spark, classes):
    counts = vocabulary(2, 250)
    near = spelling.near_pairs(spark.createDataFrame(list(counts.items()), "word string, n long"), classes)
    want = {w: sum(one_edit(w, v) for v in counts) for w in counts}
    assert {r.word: r.n_near for r in near.collect()} == {w: n for w, n in want.items() if n}


def counted(texts, min_letters, min_count):
    out = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_letters:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= min_count}


@pytest.mark.parametrize("long_text,held", [(1 << 20, 200_000), (100, 50)])
def test_words_and_counts(spark, monkeypatch, long_text, held):
    monkeypatch.setattr(spelling, "LONG_TEXT", long_text)
    monkeypatch.setattr(spelling, "HELD_WORDS", held)
    more = [(i, "Ähnlich ÉCOLE-école naïveté×÷ " * 3 + "STRASSE straße Strasse", None, None, None) for i in range(100, 400)]
    got = spelling.word_counts(frame(spark, more), 4, 2, _one_deleted)
    want = counted([r[:2] for r in [*rows(), *more]], 4, 2)
    assert {r.word: r.n for r in got.collect()} == want and "École" in want
    assert spelling.word_counts(frame(spark), 1, 1).agg(F.sum("n")).first()[0] > 0
    nothing = spelling.spelling_variants(spelling.word_counts(empty(spark), 6, 5))
    assert nothing.columns == ["word", "form", "root", "n", "n_near", "form_n"] and nothing.collect() == []


def test_letter_distances():
    words = ["abcdef", "abcdeg", "abcdefg", "bacdef", "àbcdef"]
    blocks = {n: spelling.Block(words, [5] * 5, n) for n in (6, 7)}
    i, j = spelling.replaced(blocks[6], blocks[6], same=True)
    assert {(blocks[6].words[a], blocks[6].words[b]) for a, b in zip(i, j)} == {
        ("abcdef", "abcdeg"), ("abcdef", "àbcdef")}
    i, j = spelling.inserted(blocks[7], blocks[6])
    assert [(blocks[6].words[b]) for b in j] == ["abcdef", "abcdeg"] and np.all(i == 0)
