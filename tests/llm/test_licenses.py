"""Licence scans: planted notices, thresholds, and passages of several lines."""

import re

import numpy as np
import pytest

from stocktake.llm.licenses import NOTICES, SCOPES, TEMPLATES, WHOLE, scan_licenses
from tests.llm.fixtures import empty, frame, prose

MIT = next(t for name, t in TEMPLATES if name == "MIT" and t.startswith("Permission"))


def scan(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.license_id, r.dice, r.scope) for r in scan_licenses(df, **kw).collect()}


def test_notices_are_found_where_they_stand(spark):
    words = MIT.split()
    wrapped = "\n".join(" ".join(words[i:i + 12]) for i in range(0, len(words), 12))
    got = scan(spark, [
        prose(1, 200) + "\nLICENSED under the Apache license -- version 2.0\n" + prose(2, 50),
        prose(3, 30) + "\n\n" + wrapped + "\n\n" + prose(4, 30),
        wrapped.replace("Software", "Work", 1),
        "Released under the MIT License.",
        prose(5, 300), None, "", "one",
    ])
    assert got[0] == ("Apache-2.0", 1.0, "line")
    assert got[1] == ("MIT", 1.0, "paragraph")
    assert got[2][0] == "MIT" and 0.9 < got[2][1] < 1 and got[2][2] == "paragraph"
    assert got[3] == ("MIT", 1.0, "line")
    assert all(got[i] == (None, 0.0, None) for i in (4, 5, 6, 7))


def test_dice_threshold_is_inclusive(spark):
    templates = [("a", "w1 w2 w3 w4 w5 w6"), ("b", "w1 w2 w3 w4 w5 w6")]  # 5 bigrams; ties go to the first
    got = scan(spark, ["w1 w2 w3 w4 w5 x", "w1 w2 w3 w4 y x", "w1 w2 w3 w4 w5 w6 w6 w6"], templates=templates)
    assert got[0] == ("a", 0.8, "line")
    assert got[1][0] is None
    assert got[2] == ("a", 10 / 11, "line")


def test_edge_cases_and_empty_table(spark):
    got = scan_licenses(frame(spark)).collect()
    assert len(got) == frame(spark).count() and all(r.license_id is None and r.dice == 0 for r in got)
    assert scan_licenses(empty(spark)).collect() == []


def test_whole_licences_notices_inside_lines_and_their_relatives(spark):
    mit, isc, bsd2, bsd3 = (text for _, text in WHOLE)
    gpl = next(t for name, t in TEMPLATES if name == "GPL-3.0" and t.startswith("This work"))
    apart = bsd3.replace(": 1.", ":\n\n1.").replace(". 2.", ".\n\n2.").replace(". 3.", ".\n\n3.").replace(". THIS", ".\n\nTHIS")
    got = scan(spark, [
        "Copyright 2020 A\n\n" + mit, prose(20, 300) + " " + mit + " " + prose(21, 300),
        "The text ends here and goes on. Released under the MIT License.",
        "One two three four. " + gpl + " Five six seven eight.",
        *(text for _, text in NOTICES), apart, prose(22, 400) + "\n\n" + apart, bsd2, isc,
    ])
    assert got[0] == ("MIT", 1.0, "line") and got[1] == ("MIT", 1.0, "window")
    assert got[2] == ("MIT", 1.0, "window") and got[3] == ("GPL-3.0", 1.0, "window")
    assert [got[4 + i][:2] for i in range(4)] == [(name, 1.0) for name, _ in NOTICES]
    assert got[8][:2] == ("BSD-3-Clause", 1.0) and got[9] == ("BSD-3-Clause", 1.0, "window")
    assert got[10][:2] == ("BSD-2-Clause", 1.0) and got[11][:2] == ("ISC", 1.0)


def tokens(text):
    """(line, word) of a text."""
    return [(n, w) for n, line in enumerate(text.split("\n")) for w in re.findall(r"[a-z0-9\x80-\U0010FFFF]+", line.translate(ASCII_LOWER))]


def brute_force(text, templates, n_whole, t):
    """Licence, Dice and scope by comparing every passage and every window with every template."""
    words = tokens(text or "")
    pairs = [(a[1], b[1]) for a, b in zip(words, words[1:])]
    step = [b[0] - a[0] for a, b in zip(words, words[1:])]
    sets = [{(a[1], b[1]) for a, b in zip(w, w[1:])} for w in (tokens(x) for _, x in templates)]
    whole = [k >= len(templates) - n_whole for k in range(len(templates))]

    def runs(widest):
        out, low = [], 0
        for i in range(len(pairs) + 1):
            if i == len(pairs) or step[i] > widest:
                out.append((low, i))
                low = i + 1
        return out

    def dice(a, b, k):
        own = set(pairs[a:b])
        return 2 * len(own & sets[k]) / (len(own) + len(sets[k])) if own else 0.0

    best = min(((not whole[k], -d, k, scope) for scope, widest in enumerate((0, 1, 10**9)) for a, b in runs(widest)
                for k in range(len(templates)) if (d := dice(a, b, k)) >= t), default=None)
    found = [best] if best else []
    for k in range(len(templates)):
        if best is None or (best[0] and whole[k]):
            most = int(len(sets[k]) * (2 - t) / t + 1e-9)
            for a in range(len(pairs)):
                for b in range(a + 1, min(a + most, len(pairs)) + 1):
                    if pairs[a] in sets[k] and pairs[b - 1] in sets[k] and (d := dice(a, b, k)) >= t:
                        found.append((not whole[k], -d, k, 3))
    if not found:
        return None, 0.0, None
    _, d, k, scope = min(found)
    return templates[k][0], -d, SCOPES[scope]


ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def mixture(rng, templates):
    """Pieces of templates and prose, changed here and there, on lines and paragraphs."""
    out = []
    for _ in range(rng.randint(1, 5)):
        words = rng.choice(templates)[1].split()
        if rng.random() < 0.5:
            words = words[rng.randint(0, 3):len(words) - rng.randint(0, 4)] or ["x"]
        for _ in range(rng.choice([0, 0, 1, 3])):
            words[rng.randrange(len(words))] = rng.choice(["changed", "the", "license"])
        if rng.random() < 0.6:
            words = prose(rng.randrange(999), rng.randint(1, 9)).split() + words + prose(rng.randrange(999), rng.randint(0, 9)).split()
        lines = "\n" if rng.random() < 0.2 else " "
        out.append(lines.join(words) + rng.choice([" ", "\n", "\n\n", ". "]))
    return "".join(out)


@pytest.mark.parametrize("threshold", [0.8, 0.6])
def test_every_passage_and_window_against_brute_force(spark, monkeypatch, threshold):
    import random

    from stocktake.llm import licenses
    monkeypatch.setattr(licenses, "WINDOW_ROWS", 7)
    templates = [TEMPLATES[0], *TEMPLATES[2:4], *TEMPLATES[5:7], NOTICES[3], ("two", "a b a b c")]
    whole = [("w", "one two three one two four five six seven eight one two"), ("v", "Permission is hereby granted, free of charge, to any person")]
    wanted = licenses.Templates(templates + whole, threshold, len(whole))
    rng = random.Random(5)
    texts = [mixture(rng, templates + whole) for _ in range(250)] + ["", "one", "a b a b c a b a b c", "two words", "one two three one two\n\nfour five six seven eight one two"]
    data = [x.encode() for x in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    got = licenses.scan_block(np.frombuffer(b"".join(data), np.uint8), offsets, wanted)
    for text, found in zip(texts, got):
        assert found == brute_force(text, templates + whole, len(whole), threshold), text
    assert {*SCOPES, None} == {g[2] for g in got}


def test_a_list_of_licences_is_scanned_fast():
    """A megabyte of shuffled licence phrases: no more than a few seconds in one block."""
    import random
    import time

    from stocktake.llm import licenses
    rng = random.Random(6)
    phrases = [" ".join(w[i:i + 6]) for _, x in TEMPLATES + NOTICES + WHOLE for w in [x.split()] for i in range(0, len(w), 6)]
    text = " ".join(rng.choice(phrases) for _ in range(1 << 15))[:1 << 20].encode()
    wanted = licenses.Templates(TEMPLATES + NOTICES + WHOLE, 0.8, len(WHOLE))
    begun = time.process_time()
    licenses.scan_block(np.frombuffer(text, np.uint8), np.array([0, len(text)]), wanted)
    assert time.process_time() - begun < 6
