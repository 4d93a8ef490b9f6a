"""Held-out accuracy, spans of mixed text, and the path search."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from stocktake.llm import language_id
from stocktake.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.fixtures import empty, frame, rows

VOCABULARY = {
    "en": "the and of to that with which from have would there their what".split(),
    "fr": "les des une dans pour avec être qui sur pas nous vous était".split(),
    "ru": "это как его она было только что они для меня если".split(),
    "uk": "це як його вона було тільки що вони для мене якщо їй".split(),
}


def text_of(lang, n, rng):
    return " ".join(rng.choice(VOCABULARY[lang]) for _ in range(n))


def model_for(spark, rng):
    data = [(i, text_of(lang, 60, rng), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(VOCABULARY), 80))]
    return language_id.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"), F.lit(True))


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op1_language_id"](spark, SF_CHECK).join(truth, "doc_id").where("held_out").collect()
    assert len(got) > 300 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_spans_of_mixed_text(spark):
    rng = random.Random(1)
    model = model_for(spark, rng)
    parts = [("en", text_of("en", 30, rng)), ("ru", text_of("ru", 25, rng)), ("fr", text_of("fr", 40, rng))]
    text = " -- ".join(t for _, t in parts)
    got = language_id.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [(s.lang, text[s.start:s.end]) for s in got.spans] == parts
    assert got.lang_pred == "fr" and 0 < got.score < 1


def test_edge_cases_and_empty_tables(spark):
    model = model_for(spark, random.Random(2))
    got = language_id.identify(frame(spark), model).collect()
    assert len(got) == len(rows())
    for r in got:
        text = next(t for i, t, *_ in rows() if i == r.doc_id)
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
        else:
            assert r.lang_pred in VOCABULARY and 0 < r.score <= 1
    assert language_id.identify(empty(spark), model).collect() == []
    nothing = language_id.fit(empty(spark), F.lit(True))
    assert language_id.identify(spark.createDataFrame([(1, "text")], "doc_id long, text string"), nothing).first()[1:3] == ("und", 0.0)


def test_best_path_against_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, width = int(rng.integers(1, 8)), 3
        scores = -np.minimum(rng.exponential(2, (n, width)), language_id.CLIP)
        value = lambda p: scores[np.arange(n), p].sum() - 3.0 * np.count_nonzero(np.diff(p))
        best = max(value(np.array(p)) for p in itertools.product(range(width), repeat=n))
        assert abs(value(language_id.best_path(scores, 3.0)) - best) < 1e-9


def test_blocks_do_not_change_labels(spark):
    rng = random.Random(3)
    model = model_for(spark, rng)
    texts = [text_of(rng.choice(list(VOCABULARY)), rng.randint(0, 40), rng) + " " + text_of("en", rng.randint(0, 40), rng) for _ in range(60)]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    together = language_id.label_block(np.frombuffer(b"".join(data), np.uint8), offsets, model)
    alone = [language_id.label_block(np.frombuffer(d, np.uint8), np.array([0, len(d)]), model)[0] for d in data]
    assert [(lang, spans) for lang, _, spans in together] == [(lang, spans) for lang, _, spans in alone]


def test_shortcut_agrees_with_the_path_search(spark):
    """Every text labelled by the path search, whether or not the shortcut would spare it."""
    rng = random.Random(8)
    model = model_for(spark, rng)
    langs = list(VOCABULARY)
    texts = [" ".join(text_of(rng.choice(langs), rng.choice([0, 1, 3, 12]), rng) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    data = [t.encode() for t in [*texts, "", "12 34", "a"]]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    block = np.frombuffer(b"".join(data), np.uint8)
    fast, searched = (language_id.label_block(block, offsets, model, shortcut=s) for s in (True, False))
    assert sum(len(spans) > 1 for _, _, spans in fast) > 20 and sum(len(spans) == 1 for _, _, spans in fast) > 20
    for a, b in zip(fast, searched):
        assert a[0] == b[0] and a[2] == b[2] and abs(a[1] - b[1]) < 1e-9


def test_long_text(spark):
    """One text of some megabytes is labelled whole, and as its parts are."""
    rng = random.Random(9)
    model = model_for(spark, rng)
    part = {lang: text_of(lang, 4000, rng) for lang in list(VOCABULARY)[:2]}
    text = " ".join(part[lang] for lang in [*part] * 25)
    lang, score, spans = language_id.label_block(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), model)[0]
    assert len(text) > 900_000 and [s[0] for s in spans] == [*part] * 25 and spans[-1][2] >= len(text) - 1
