"""The entry point without the training-data folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder):
    code = "import __spark_entry__ as e; print(*e.queries())"
    out = subprocess.run(
        [sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, check=True
    )
    return set(out.stdout.split())


def test_entry_without_the_training_data_folders(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    left, whole = _names(tmp_path / "copy"), _names(ROOT)
    assert left <= whole and "vocab" in left
    assert "pipeline" not in left and not any(n.startswith("op1_") for n in left)
