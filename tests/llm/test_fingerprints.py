"""Sketches and the edited-text report against Python."""

import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from stocktake.llm import fingerprints
from tests.llm.fixtures import empty, frame, prose, rows, words


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def chained(numbers):
    """Spark's hash of several longs: each seeds the next."""
    seed = 42
    for x in numbers:
        seed = xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), seed=seed)
    return signed(seed)


def sketch(text, k=128, n=5):
    w = [signed(xxhash.xxh64_intdigest(x.encode(), seed=42)) for x in words(text)]
    grams = [w[i:i + n] for i in range(len(w) - n + 1)] if len(w) >= n else ([w] if w else [])
    return sorted({chained(g) for g in grams})[:k]


def likeness(a, b, k=128):
    if not a and not b:
        return 1.0
    union = sorted(set(a) | set(b))[:k]
    return len([x for x in union if x in set(a) & set(b)]) / len(union)


def as_text(s):
    return ",".join(format(x & (1 << 64) - 1, "x") for x in s)


def brute_force(data):
    texts = {}
    for i, t in data:
        if i is not None:
            texts[i] = min(t or "", texts.get(i, t or ""))
    order = sorted(texts, reverse=True)
    nxt = {i: texts[order[(j + 1) % len(order)]] for j, i in enumerate(order)}
    out = []
    for i, t in data:
        t = t or ""
        third, follow = len(t) // 3, nxt.get(i, "")
        edited = t[:len(t) - third] + follow[:third]
        a, b, c = sketch(t), sketch(edited), sketch(follow) if i is not None else []
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), as_text(a), as_text(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("per_range", [50_000, 3])
def test_report_against_brute_force(spark, monkeypatch, per_range):
    monkeypatch.setattr(fingerprints, "RANGE_IDS", per_range)
    got = fingerprints.edited_pairs(frame(spark)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute_force([(i, t) for i, t, *_ in rows()])


def test_single_document_and_empty_table(spark):
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")
    got = fingerprints.edited_pairs(one).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == brute_force([(5, "a b c d e f")])
    assert fingerprints.edited_pairs(empty(spark)).collect() == []


def test_main_path_has_no_python(spark):
    plan = fingerprints.edited_pairs(frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_sketches_merge_and_estimate(spark):
    left, right = prose(1, 900), prose(2, 600)
    df = spark.createDataFrame([(left, right, left + " " + right, "", "one")], "l string, r string, both string, e string, o string")
    s = {c: fingerprints.sketch(F.col(c)) for c in df.columns}
    got = df.select(
        fingerprints.merge(s["l"], s["r"]).alias("merged"), s["both"].alias("whole"),
        fingerprints.distinct_shingles(s["both"]).alias("n"), fingerprints.containment(s["l"], s["both"]).alias("inside"),
        fingerprints.resemblance(s["l"], s["both"]).alias("like"), fingerprints.distinct_shingles(s["o"]).alias("one"),
        fingerprints.resemblance(s["e"], s["e"]).alias("empty"), fingerprints.resemblance(s["e"], s["o"]).alias("none")).first()
    assert len(set(got.merged) & set(got.whole)) >= 124  # all but the shingles across the seam
    assert abs(got.n - 1496) < 350 and got.inside > 0.8 and abs(got["like"] - 0.6) < 0.15
    assert (got.one, got.empty, got.none) == (1.0, 1.0, 0.0)
