"""The queries without the training-data package."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import saleswh
from saleswh.queries.registry import QUERIES

ROOT = Path(saleswh.__file__).parent.parent


def test_the_rest_imports_without_the_training_data_package(tmp_path):
    tree = tmp_path / "copy"
    shutil.copytree(ROOT, tree, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", "spark-warehouse"))
    code = "import __spark_entry__ as e; print(sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    found = subprocess.run([sys.executable, "-c", code], cwd=tree, capture_output=True, text=True, timeout=120, check=False)
    assert found.returncode == 0, found.stderr
    assert found.stdout.strip() == str(sorted(QUERIES))
