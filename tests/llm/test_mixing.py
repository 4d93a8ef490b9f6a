"""The mix: targets, nearness to them, repeat limits, reruns."""

import random

import pytest

from stocktake.llm import mixing
from tests.llm.fixtures import empty, frame, rows, words


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Water filling by hand: {source: target} from {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check(got, data, longest=None):
    sizes = {}
    for _, t, _, s, *_ in data:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, words_ in taken.items():
        most = max((r.size for r in got if r.source == s), default=0) if longest is None else longest
        assert abs(words_ - want[s]) <= most, (s, words_, want[s])


def test_edge_cases(spark):
    got = mixing.mix_sources(frame(spark)).collect()
    assert len(got) == len(rows())
    check(got, rows())


def test_large_source_meets_its_target_closely_and_reruns_agree(spark):
    rng = random.Random(4)
    data = [(i, "w " * rng.randint(0, 60), "en", rng.choice(["hot"] * 6 + ["b", "c", "d", None]), 0) for i in range(4000)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix_sources(df).collect()
    check(got, data, longest=60)
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sorted(map(str, got)) != sorted(map(str, mixing.mix_sources(df, seed=1).collect()))
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in got if r.copies}


def test_longer_documents_are_sampled_more_often(spark):
    data = [(i, "w " * (10 if i % 2 else 40), "en", "ab"[i % 4 // 2], 0) for i in range(2000)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix_sources(df, weights=(1, 9), share=0.8, max_repeats=1).where("source = 'a'").collect()
    rate = {n: [r.copies for r in got if r.size == n] for n in (10, 40)}
    assert sum(rate[40]) > 1.5 * sum(rate[10]) > 0


def test_empty_tables_and_empty_sources(spark):
    assert mixing.mix_sources(empty(spark)).collect() == []
    assert mixing.mixed_rows(empty(spark)).collect() == []
    df = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.target, r.taken) for r in mixing.mix_sources(df).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_rows_that_tie_are_split_at_the_target(spark):
    """A thousand equal rows without id, in a source that is to give 3,333.3 of its 4,000 words."""
    tied = [(None, "one two three four", "a")] * 1000
    rest = [(i, "one two three four", s) for s in "bc" for i in range(1000)]
    df = spark.createDataFrame(tied + rest, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix_sources(df, weights=(5, 10, 12), share=0.75, max_repeats=1).collect()
    by_source = {s: [r for r in got if r.source == s] for s in "abc"}
    for s, rows_ in by_source.items():
        assert len(rows_) == 1000 and abs(sum(r.taken for r in rows_) - rows_[0].target) <= 2
        assert {r.copies for r in rows_} <= {0, 1}
    assert 1000 < by_source["a"][0].target < 2000
    mixed = mixing.mixed_rows(df, weights=(5, 10, 12), share=0.75, max_repeats=1)
    assert mixed.where("source = 'a'").count() == sum(r.copies for r in by_source["a"])
    again = mixing.mix_sources(df.repartition(3), weights=(5, 10, 12), share=0.75, max_repeats=1).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_repeated_rows_that_differ_elsewhere_are_told_apart(spark):
    data = [(7, "w " * 10, "a", i) for i in range(300)] + [(i, "w " * 10, "b", 0) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    kept = mixing.mixed_rows(df, weights=(1, 1), share=0.5, max_repeats=1)
    assert abs(kept.where("source = 'a'").count() - 150) <= 1 and kept.where("source = 'a'").distinct().count() == kept.where("source = 'a'").count()


def test_sql_agrees_on_rows_without_id(spark, tmp_path):
    import duckdb

    from stocktake.llm.queries import ORACLE_SQL, QUERIES
    df = frame(spark, [(None, "same words here", "en", "a", 15)] * 40 + [(None, f"other {i}", "en", "b", 7) for i in range(40)], clash=False)
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = con.execute(ORACLE_SQL["op5_source_mix"])
    names = [d[0] for d in found.description]
    got = QUERIES["op5_source_mix"](spark, str(tmp_path))
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, found.fetchall()))
