"""Held-out accuracy of the classifier and its edge cases."""

import numpy as np
from pyspark.sql import functions as F

from stocktake.llm import quality
from stocktake.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.fixtures import empty, frame, prose, rows


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    got = QUERIES["op4_quality"](spark, SF_CHECK).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def labelled(spark):
    data = [(i, prose(i, 40) if i % 2 else " ".join(w + "***" for w in prose(i, 40).split()), i % 2) for i in range(60)]
    return (spark.createDataFrame([d[:2] for d in data], "doc_id long, text string"),
            spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (3, None), (5, 1)], "doc_id long, quality int"))


def test_edge_cases(spark):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels, "quality", F.lit(True))
    got = quality.with_score(frame(spark), model).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert quality.with_score(empty(spark), model).collect() == []
    scored = {r.doc_id: r.score for r in quality.with_score(docs, model).collect()}
    assert all((scored[i] > 0.5) == bool(i % 2) for i in range(60))
    again = quality.fit(docs.repartition(5), labels, "quality", F.lit(True))
    assert (again[0] == model[0]).all() and again[1] == model[1]


def test_no_labels_and_one_class(spark):
    docs, labels = labelled(spark)
    for some, want in ((labels.limit(0), 0.5), (labels.where("quality = 1"), None)):
        model = quality.fit(docs, some, "quality", F.lit(True))
        scores = {r.score for r in quality.with_score(docs, model).collect()}
        assert len(scores) == 1 and (want is None or scores == {want})


def test_features_do_not_depend_on_the_block():
    texts = [b"", b"one", "é ß  two\ttwo two".encode(), b" lead and trail ", b"x"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = quality.features(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for i, t in enumerate(texts):
        alone = quality.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        for (b, at), (c, _) in zip(together, alone):
            assert b[at[i]:at[i + 1]].tolist() == c.tolist()


def test_scores_are_the_average_and_softmax(spark):
    docs, labels = labelled(spark)
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    rows_ = [(*quality.histogram(r.text.encode()), known[r.doc_id]) for r in docs.orderBy("doc_id").collect()]
    vectors, layer, bias = quality.train_parts(rows_)
    table = vectors @ (layer[:, 1] - layer[:, 0])
    for r in quality.with_score(frame(spark), (table, float(bias[1] - bias[0]))).collect():
        buckets, shares = quality.histogram((r.text or "").encode())
        z = (shares.astype(float) @ vectors[buckets].astype(float)) @ layer + bias
        p = np.exp(z - z.max())
        assert abs(r.score - p[1] / p.sum()) < 1e-4


def test_sample_is_bounded_whatever_repeats(spark):
    docs, labels = labelled(spark)
    hot_docs = docs.unionByName(spark.range(500).selectExpr("1L AS doc_id", "concat('copy ', id) AS text"))
    hot_labels = labels.unionByName(spark.range(500).selectExpr("1L AS doc_id", "1 AS quality"))
    model = quality.fit(hot_docs, hot_labels, "quality", F.lit(True))
    assert {round(r.score) for r in quality.with_score(docs, model).where("doc_id > 1").collect()} == {0, 1}
    few = quality.fit(docs, labels, "quality", F.lit(True), sample_bytes=1)  # one document is left: one class
    assert len({r.score for r in quality.with_score(docs, few).collect()}) == 1


def test_long_texts_are_scored_in_slices(spark, monkeypatch):
    """Slices give what the whole text gives, cut anywhere, also within very long words."""
    rng = np.random.default_rng(0)
    table = rng.normal(size=1 << quality.BITS).astype(np.float32)
    words_ = ["a", "bb", "é" * 9, "x" * 700, "long" * 40, "w"]
    for n in (0, 1, 400, 3000):
        text = "".join(rng.choice(words_) + rng.choice([" ", "  ", "\n", "\t "]) for _ in range(n)).encode()
        data, ends = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        whole = [b for b, _ in quality.features(data, ends)]
        want = sum(float(table[b].sum(dtype=np.float64)) for b in whole), sum(map(len, whole))
        counts = np.bincount(np.concatenate(whole), minlength=1 << quality.BITS)
        for size in (64, 1000, 1 << 22):
            monkeypatch.setattr(quality, "SLICE_BYTES", size)
            got = quality.long_text_total(data, table)
            assert got[1] == want[1] and abs(got[0] - want[0]) < 1e-2
            buckets, shares = quality.histogram(text)
            assert (buckets == np.flatnonzero(counts)).all() and np.allclose(shares, counts[buckets] / max(1, counts.sum()))
