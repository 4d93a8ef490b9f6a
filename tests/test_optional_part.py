"""The entry without the optional training-data part."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("gone", [["stocktake/llm", "tests/llm"], ["stocktake/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_imports_without_the_llm_folders(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", "__pycache__", "*.json", *[os.path.basename(g) for g in gone]))
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    from stocktake.plans import registry
    registry.load_all()
    assert out.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLE_SQL)), "False"]
