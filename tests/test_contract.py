"""The library without its optional corpus part."""

from __future__ import annotations

import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_without_the_corpus_operators(tmp_path):
    """`__spark_entry__` imports and keeps all other queries in a copy that lacks reportloom/llm."""
    shutil.copytree(ROOT / "reportloom", tmp_path / "reportloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    code = "import __spark_entry__ as c; from reportloom.catalog import QUERIES; assert set(c.queries()) == set(QUERIES)"
    for _ in range(2):  # with the pipeline's file and without it
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
