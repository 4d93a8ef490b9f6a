"""Helpers on bytes: hashes do not depend on how a text is cut for them, and memory stays bounded."""

import os
import subprocess
import sys

import numpy as np
import pytest

from stocktake.llm import common, minhash
from stocktake.llm.components import components
from stocktake.session import checkpoint_dir
from tests.conftest import ROOT
from tests.llm.fixtures import frame, prose


def test_spans_hash_alike_whatever_is_hashed_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    text = b" ".join(bytes(rng.integers(97, 100, rng.integers(1, 30)).astype(np.uint8)) for _ in range(500)) + b" " + b"z" * 900
    data, ends = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole, at = common.word_hashes(data, ends)
    for size in (1, 50, 700):
        monkeypatch.setattr(common, "HASH_BYTES", size)
        again, _ = common.word_hashes(data, ends)
        assert (again == whole).all() and at.tolist() == [0, 501]
    assert len(common.word_hashes(data[:0], np.array([0, 0]))[0]) == 0


LONG = """
import resource, sys
import numpy as np
from stocktake.llm import {module}
rng = np.random.default_rng(0)
words = rng.integers(97, 123, (64 << 20) // 8 * 8).astype(np.uint8).reshape(-1, 8)
words[:, 7] = 32
data = words.ravel()
ends = np.array([0, len(data)])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
{code}
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""


@pytest.mark.parametrize("module,code", [
    ("minhash", "s = next(minhash.shingle_sets(data, ends, 5)); minhash.fill_sketch(s, 240); assert len(s) > 8_000_000"),
    ("quality", "t, n = quality.long_text_total(data, np.ones(1 << quality.BITS, np.float32)); assert n > 64_000_000"),
])
def test_a_text_of_64_megabytes_takes_less_than_two_gigabytes(module, code):
    out = subprocess.run([sys.executable, "-c", LONG.format(module=module, code=code)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 2000, out.stdout


KEPT = """
import numpy as np
from stocktake.llm.common import tidied
held = []
def resident():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
def work(batches):
    for batch in batches:
        parts = [np.ones(60_000, np.uint8) for _ in range(4000)]
        held.append(parts[-1])  # keeps the heap from shrinking at its end
        yield batch
run = tidied(work)
before = resident()
list(run([1, 2]))
print(resident() - before)
"""


def test_a_worker_gives_back_what_a_task_has_freed():
    out = subprocess.run([sys.executable, "-c", KEPT], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 60, out.stdout


@pytest.fixture
def many_partitions(spark):
    """Shuffles into 40 partitions that nothing merges, as for a table much larger than what is left of it."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_small_tables_are_not_strewn_over_files(many_partitions):
    spark = many_partitions
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 600, 3)] + [(i + 1, i + 2) for i in range(0, 600, 3)], "a long, b long")
    found = components(links)
    assert sorted(map(tuple, found.collect())) == [(i, i - i % 3) for i in range(600)]
    assert len(found.inputFiles()) == 1
    assert common.in_tasks(found.repartition(40), 5 * common.TASK_ROWS).rdd.getNumPartitions() == 5

    texts = [(1000 + i, prose(i % 40, 60) + " x" * (i // 40), "en", "a", 0) for i in range(120)]
    docs = frame(spark, texts, clash=False).coalesce(2)
    parts = lambda: {f for d, _, names in os.walk(checkpoint_dir(spark).removeprefix("file:")) for f in names if f.startswith("part-")}
    had = parts()
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert all(got[1000 + i] == 1000 + i % 40 for i in range(120))
    assert len(parts() - had) < 60
