"""Backoff scores against plain counting."""

import math
from collections import Counter

import numpy as np

from stocktake.llm import chunks, lm_scores
from tests.llm.fixtures import empty, frame, prose, rows, words


def brute_force(data):
    texts = [words(t, lower=True) for _, t in data]
    grams = [Counter(tuple(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)) for w in texts]
    total = sum(grams, Counter())
    n_all = sum(map(len, texts))
    out = []
    for (i, _), w, own in zip(data, texts, grams):
        c = lambda *g: total[g] - own[g]
        log = 0
        for k, x in enumerate(w):
            if k > 1 and c(w[k - 2], w[k - 1], x):
                s = c(w[k - 2], w[k - 1], x) / c(w[k - 2], w[k - 1])
            elif k > 0 and c(w[k - 1], x):
                s = 0.4 * c(w[k - 1], x) / c(w[k - 1])
            else:
                s = 0.16 * c(x) / n_all if c(x) else 0.064 / n_all
            log += round(math.log(s) * 1e6)
        out.append((i, len(w), log, log / len(w) / 1e6 if w else None))
    return sorted(out, key=str)


def test_edge_cases_against_brute_force(spark):
    got = lm_scores.backoff_scores(frame(spark)).collect()
    assert sorted(map(tuple, got), key=str) == brute_force([(i, t) for i, t, *_ in rows()])


def test_many_chunks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(chunks, "RANGE_ITEMS", 300)
    data = [(i, prose(i % 25, 40) + " " + prose(i, 20)) for i in range(60)]
    got = lm_scores.backoff_scores(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(data)


def test_empty_table(spark):
    assert lm_scores.backoff_scores(empty(spark)).collect() == []


def test_ngrams_of_the_same_hash(spark, monkeypatch):
    """A 3-gram and a 2-gram whose parts no other text has meet the hashes of a common word and 3-gram."""
    items = lm_scores.ngram_items
    data = [(1, "only here seen"), (2, "the cat sat on the mat"), (3, "the cat sat by the door"), (4, "just twice")]
    key = {g: items(np.frombuffer(g.encode(), np.uint8), np.array([0, len(g)]))[0][-1]
           for g in ("only here seen", "the", "just twice", "the cat sat")}

    def met(texts, offsets):
        keys, counts = items(texts, offsets)
        keys[keys == key["only here seen"]] = key["the"]
        keys[keys == key["just twice"]] = key["the cat sat"]
        return keys, counts

    monkeypatch.setattr(lm_scores, "ngram_items", met)
    got = lm_scores.backoff_scores(spark.createDataFrame(data, "doc_id long, text string")).collect()
    want = brute_force(data)
    assert [tuple(r) for r in sorted(got) if r.doc_id in (1, 4)] == [w for w in want if w[0] in (1, 4)]
    assert [r.n_words for r in sorted(got)] == [w[1] for w in want]


def test_scores_of_totals_above_those_of_the_parts():
    n = 100
    floor = round(math.log(0.064 / n) * 1e6)
    assert lm_scores.log_score(2, np.array([0, 0, 1]), n) == 2 * floor
    assert lm_scores.log_score(3, np.array([0, 0, 0, 0, 0, 1]), n) == 3 * floor
    # Known words, a 3-gram whose 2-grams nothing else has.
    assert lm_scores.log_score(3, np.array([4, 4, 4, 0, 0, 1]), n) == 3 * round(math.log(0.16 * 4 / n) * 1e6)
    # Totals that fit are taken as they are.
    right = [math.log(0.16 * 4 / n), math.log(0.4 * 3 / 4), math.log(2 / 3)]
    assert lm_scores.log_score(3, np.array([4, 5, 6, 3, 2, 2]), n) == sum(round(x * 1e6) for x in right)
