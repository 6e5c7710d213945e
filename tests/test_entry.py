"""The entry point with and without the operators for training data."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTED = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


@pytest.mark.parametrize("gone", [("billbook/llm", "tests/llm"), ("billbook/llm", "tests/llm", "corpus_pipeline.py")])
def test_lists_the_lake_queries_without_them(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(folder, n), ROOT) in gone
    ])
    from workload.queries import QUERIES

    run = subprocess.run(
        [sys.executable, "-c", LISTED], cwd=copy, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True
    )
    assert run.returncode == 0, run.stderr
    listed, with_sql = (line.split() for line in run.stdout.splitlines())
    assert listed == list(QUERIES) and set(with_sql) <= set(listed)
