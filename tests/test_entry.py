"""The entry in copies of the whole repository that lack the optional parts, as a driver may leave them."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [["lodeweave/llm", "tests/llm"], ["lodeweave/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_whole_copy_without_optional_parts(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse"))
    for name in gone:
        shutil.rmtree(copy / name, ignore_errors=True)
        (copy / name).unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and callable(e.entry); print(len([k for k in q if k == 'pipeline' or k[:2] == 'op' and k[2].isdigit()]), len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)}).stdout.split()
    left = 10 if (copy / "lodeweave" / "llm").exists() else 0
    assert int(out[0]) == left and int(out[1]) > 40 + left
