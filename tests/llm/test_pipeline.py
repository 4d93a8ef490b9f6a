"""The pipeline on a small table against its stages done by hand."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from stocktake.llm import bpe
from tests.llm.fixtures import frame, prose, words
from tests.llm.test_minhash import brute_force as groups
from tests.llm.test_substring_dedup import brute_force as passages

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_and_their_signatures():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "mixing", "tokens"]


def test_run_against_stages_by_hand(spark, tmp_path):
    data, labels = [], []
    shared = prose(900, 45)
    for i in range(120):
        text = prose(i, 60) + (" " + shared if i % 10 == 0 else "")
        if i % 6 == 5:
            text = " ".join(w + "***" for w in text.split())
        if i % 17 == 16:
            text = data[i - 1][1] + " more"
        data.append((i, text, "en", f"s{i % 3}", len(text)))
        if i % 2 or i % 6 == 2:
            labels.append((i, int(i % 6 != 5), 0))
    data += [(200, None, "en", "s0", None), (201, "", "en", "s1", 0)]
    spark.createDataFrame(data, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = {r.doc_id: r.text for r in corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).collect()}
    assert all((i in left) == (i % 6 != 5) for i in range(120) if i % 17 != 16 and i % 6 != 4)
    left = {i: t for i, t in left.items() if (i, True) in {(a, d) for a, _, _, d in groups(list(left.items()), 5, 80)}}
    kept = {i: (n, gone, sha) for i, n, gone, sha in passages(list(left.items()), 35)}
    assert sum(gone for _, gone, _ in kept.values()) >= 45 * 5
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    copies = Counter(r.doc_id for r in got)
    assert set(copies) <= set(kept) and max(copies.values()) <= 2
    source = {i: s for i, _, _, s, _ in data}
    sizes, taken = Counter(), Counter()
    for i, (n, gone, _) in kept.items():
        sizes[source[i]] += n - gone
        taken[source[i]] += copies[i] * (n - gone)
    from tests.llm.test_mixing import targets
    for s, target in targets(sizes).items():
        assert abs(taken[s] - target) <= 110
    for r in got:
        text = b"".join(library.decode_single_token_bytes(t) for t in r.ids).decode()
        assert hashlib.sha256(" ".join(words(text)).encode()).hexdigest() == kept[r.doc_id][2]
        assert library.encode_ordinary(text) == r.ids and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()


def test_clean_documents_stay(spark, tmp_path):
    """Every stage on its own leaves unlike, clean documents alone."""
    data = [(i, prose(i, 80), "en", "s", 0) for i in range(40)]
    docs = spark.createDataFrame(data, COLUMNS)
    for stage in (corpus_pipeline.near_duplicate_stage, corpus_pipeline.substring_stage):
        out = stage(spark, docs, "unused")
        assert out.columns == docs.columns
        assert sorted((r.doc_id, r.text) for r in out.collect()) == [(i, t) for i, t, *_ in data]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_and_rows_without_id_leave_one_text(spark, tmp_path):
    """One row of each group reaches the next stage, so no clean text is erased there as its own copy."""
    lone, other = prose(950, 60), prose(951, 60)
    more = [(None, lone, "en", "a", len(lone)), (None, lone, "en", "a", len(lone)),
            (30, other, "en", "a", len(other)), (30, other + " more", "en", "a", len(other) + 5),
            (31, prose(952, 60), "en", "a", 0), (31, prose(953, 60), "en", "a", 0),
            (32, prose(954, 60), "en", "b", 1), (32, prose(954, 60), "en", "a", 2), (29, prose(952, 60) + " x", "en", "a", 0)]
    docs = frame(spark, more, clash=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "unused").collect()
    base = prose(1, 120)
    assert [r.doc_id for r in got if r.text in (base, base.replace(" ", "  "))] == [1]
    assert [r.doc_id for r in got if r.text == lone] == [None]
    assert len([r for r in got if r.doc_id == 16]) == 1
    assert len([r for r in got if r.doc_id == 30]) == 1
    # Of two unlike texts under one id, only the one with a copy of smaller id goes.
    assert [r.text for r in got if r.doc_id == 31] == [prose(953, 60)]
    assert [(r.source, r.n_chars) for r in got if r.doc_id == 32] == [("a", 2)]
    assert {r.doc_id for r in got} >= {1, 7, 8, 9, 10, 29}
    kept = {(r.doc_id, r.text) for r in got}
    for r in corpus_pipeline.substring_stage(spark, spark.createDataFrame(got, docs.schema), "unused").collect():
        if r.doc_id in (None, 1, 16, 30, 32):
            assert (r.doc_id, r.text) in kept
    through = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert all(n > 0 for i, n in through.items() if i in (1, 16, 30, 32))
