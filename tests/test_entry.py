"""The driver contract holds with and without the training-data subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def test_every_sql_belongs_to_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_imports_without_the_subpackage(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "cinestar", tmp_path / "cinestar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    found = subprocess.run(
        [sys.executable, "-c", code],
        cwd=tmp_path,
        env={"PYTHONPATH": str(tmp_path)},
        capture_output=True,
        text=True,
        check=True,
    )
    from cinestar.plans.registry import QUERIES

    assert found.stdout.split() == [str(len(QUERIES)), "False"]
