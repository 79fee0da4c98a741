"""The driver contract in __spark_entry__.py."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
from tests.conftest import ROOT


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["series_key", "field", "n_records", "first_ns", "last_ns"]
    assert df.count() > 0


def test_contract_shapes():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert set(q) - set(sql) - set(E.LLM_QUERIES) == set(E.ROWS_ONLY)
    assert all(callable(f) for f in q.values())


def test_works_without_the_llm_folders(tmp_path):
    """A copy without them imports, registers the core queries alone, and its tests collect."""
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "*.json")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=gone)
    code = ("import __spark_entry__ as E; assert not E.LLM_QUERIES and 'pipeline' not in E.queries() "
            "and 'flagship' in E.queries() and set(E.oracle_sql()) <= set(E.queries())")
    env = {**os.environ, "PYTHONPATH": ""}
    for cmd in ([sys.executable, "-c", code], [sys.executable, "-m", "pytest", "-q", "--collect-only", "tests"]):
        done = subprocess.run(cmd, cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-2000:]
