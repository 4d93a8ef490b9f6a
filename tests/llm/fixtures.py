"""Small tables with the awkward cases that every operator must define."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = ["the", "ing", "er", "on", "st", "re", "é", "ß", "ch", "qu"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows():
    """(doc_id, text, lang, source, n_chars): NULLs, empties, copies, near copies, one long text."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    passage = prose(2, 60)
    texts = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, base.upper(), "en", "b"),
        (5, prose(3, 90) + "\n" + passage, "fr", "a"), (6, passage + " " + prose(4, 40), "fr", "c"),
        (7, "", "de", "c"), (8, None, "de", "c"), (9, " \t\n", None, None), (10, "one", None, "a"), (11, "two words", "en", None),
        (12, prose(5, 30_000), "es", "d"), (13, "日本語のテキスト, русский текст", None, "a"), (14, "12 34 !!", "en", "a"),
        (15, " nbsp stays ", "en", "a"), (None, prose(6, 50), "en", "a"), (None, base, "en", "a"),
        (16, prose(7, 80), None, "b"), (16, prose(7, 80), None, "b"), (17, "x" * 5000, "en", "b"),
        (18, "word " * 300, "en", "b"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in texts]


def frame(spark, extra=(), clash=True):
    """The rows as a DataFrame; ``clash`` adds columns named like results and helpers."""
    df = spark.createDataFrame([*rows(), *extra], SCHEMA)
    if clash:
        for name in ("score", "size", "digest", "n_words", "node", "bucket", "rank", "kept", "chunk", "component_id"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return WS.findall(text)
