"""Encoding against the public library of the rank file, decoding by round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from stocktake.llm import bpe
from tests.llm.fixtures import empty, frame, rows

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(RANKS)


def test_rows_match_the_library(spark):
    got = bpe.tokenize(frame(spark), RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for i, text, *_ in rows():
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_decoding_gives_the_text_back(spark):
    encoded = bpe.tokenize(frame(spark).where("text IS NOT NULL"), RANKS, public_tokenizers.PATTERN)
    got = bpe.detokenize(encoded, RANKS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, t) for i, t, *_ in rows() if t is not None), key=str)


def test_short_and_long_pieces_agree_with_the_library(vocab):
    rng = random.Random(0)
    pieces = ["a", "é" * 32, "é" * 33, "x" * 63, "x" * 64, "ab" * 700]
    pieces += ["".join(rng.choice("abthe é日😀1") for _ in range(rng.randint(1, 64))) for _ in range(200)]
    for piece in pieces:
        body = piece.encode()
        want = LIBRARY._encode_single_piece(body)
        if RANKS.get(body) is None:
            assert bpe.encode_long(body, vocab) == want
            if len(body) <= bpe.SHORT:
                ids = bpe.encode_block([body, b"th"], vocab)[0]
                assert ids[ids >= 0].tolist() == want


def test_emptied_memory_and_runs_change_nothing(vocab, monkeypatch):
    texts = [t or "" for _, t, *_ in rows()] * 2
    want = bpe.Encoder(vocab, public_tokenizers.PATTERN).encode(texts)
    monkeypatch.setattr(bpe, "MEMORY", 50)
    monkeypatch.setattr(bpe, "RUN", 30)
    assert bpe.Encoder(vocab, public_tokenizers.PATTERN).encode(texts) == want


def test_empty_table(spark):
    assert bpe.tokenize(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
