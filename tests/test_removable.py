"""The training-text parts can be deleted, with or without the pipeline file, and the rest still lists its queries."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = """
import __spark_entry__ as e
names, sql = e.queries(), e.oracle_sql()
assert "w2_normalised_curve" in names and "w2_normalised_curve" in sql and len(names) > 150
assert not [n for n in [*names, *sql] if n == "pipeline" or n.startswith("op")]
"""


@pytest.mark.parametrize("gone", [["loanloom/llm"], ["loanloom/llm", "corpus_pipeline.py"]])
def test_entry_without_text_operators(tmp_path, gone):
    left_out = {os.path.join(ROOT, g) for g in [*gone, ".git", "tests"]}
    skip = lambda folder, names: [n for n in names if os.path.join(folder, n) in left_out or n == "__pycache__"]
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    env = {**os.environ, "PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
