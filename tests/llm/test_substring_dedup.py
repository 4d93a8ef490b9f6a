"""Passage removal against a count of all windows in Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from stocktake.llm import chunks, substring_dedup
from tests.llm.fixtures import empty, frame, prose, rows, words


def brute_force(data, n):
    split = [words(t) for _, t in data]
    windows = Counter(tuple(w[i:i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for i, t in data:
        w = words(t)
        gone = set()
        for s in range(len(w) - n + 1):
            if windows[tuple(w[s:s + n])] > 1:
                gone.update(range(s, s + n))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [2, 35, 50])
def test_edge_cases_against_brute_force(spark, n):
    got = substring_dedup.dedup_substrings(frame(spark), n=n).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_force([(i, t) for i, t, *_ in rows()], n)


def test_many_chunks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(chunks, "RANGE_ITEMS", 200)
    shared = prose(99, 40)
    data = [(i, " ".join([prose(100 + i, 70), shared if i % 3 == 0 else "", prose(200 + i % 4, 60)])) for i in range(30)]
    data += [(100 + i, prose(300, 50)) for i in range(20)]
    got = (substring_dedup.dedup_substrings(spark.createDataFrame(data, "doc_id long, text string"), n=35)
           .select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert sorted(map(tuple, got), key=str) == brute_force(data, 35)


def test_text_around_a_passage_keeps_its_shape(spark):
    shared = prose(7, 40)
    data = [(1, f"First  line\nwith\ttabs {shared}\nlast line"), (2, shared), (3, "untouched \n text "), (4, None)]
    got = substring_dedup.dedup_substrings(spark.createDataFrame(data, "doc_id long, text string"), n=35).collect()
    assert {r.doc_id: r.kept_text for r in got} == {
        1: "First  line\nwith\ttabs last line", 2: "", 3: "untouched \n text ", 4: None}


def test_empty_table(spark):
    assert substring_dedup.dedup_substrings(empty(spark)).collect() == []


def test_packed_numbers_come_back():
    import numpy as np
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (chunks.unpack_sorted(chunks.pack_sorted(keys)) == keys).all()
    assert (chunks.from_planes(chunks.planes(keys)) == keys).all()
    assert len(chunks.unpack_sorted(chunks.pack_sorted(keys[:0]))) == 0


def test_items_that_share_a_hash_are_told_apart(spark):
    """a and b have one key but unlike second hashes, so no text believes their total; c's is believed."""
    def items(data, offsets):
        first = data[offsets[:-1]]
        keys = np.where(first == ord("c"), np.uint64(7 << 60), np.uint64(3 << 60))
        return keys, np.ones(len(first), np.int64), first.astype(np.uint64)

    def per_text(data, offsets, copies, counts, totals):
        for i, t in enumerate(totals.tolist()):
            yield chr(data[offsets[i]]), int(t)

    docs = spark.createDataFrame([(w + str(i) * 3000,) for i, w in enumerate("aabcc")] + [("c" + "4" * 3000,)], "text string")
    got = chunks.with_totals(docs, "text", items, per_text, "word string, total long", items_per_byte=0.001, chunk_bytes=1)
    assert sorted((r.word, r.total) for r in got.collect()) == [("a", 1), ("a", 1), ("b", 1), ("c", 3), ("c", 3)]


def test_second_hashes_are_of_the_words():
    from stocktake.llm.common import mix64, window_hashes
    words_ = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = np.array([0, 120, 199])
    first, second = (window_hashes(w, at, 35)[0] for w in (words_, mix64(words_ + np.uint64(35))))
    assert len(np.unique(first)) == len(np.unique(second)) == len(first) and len(np.unique(second & chunks.LOW)) > len(first) - 5
    assert abs(np.corrcoef((first & chunks.LOW).astype(float), (second & chunks.LOW).astype(float))[0, 1]) < 0.3
