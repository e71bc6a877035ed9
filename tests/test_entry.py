"""The entry module without its optional part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

RUN = """
import tempfile
from ledgerlake.session import get_session
import __spark_entry__ as entry
names = entry.queries()
assert len(names) >= 72 and not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert set(entry.oracle_sql()) <= set(names)
spark = get_session("local[2]", 2, extra={"spark.checkpoint.dir": tempfile.mkdtemp()})
assert names["f1_status_counts"](spark, "/root/testdata/sf0.001").count() == 7
assert entry.entry(spark).count() > 0
"""


def copy_of_repo(tmp_path: Path) -> Path:
    out = tmp_path / "repo"
    shutil.copytree(ROOT, out, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "spark-warehouse"))
    return out


@pytest.mark.parametrize("keep_pipeline", [False, True])
def test_entry_without_the_subpackage(tmp_path, keep_pipeline):
    """Both ``llm`` folders are gone; the pipeline's file may be left behind."""
    repo = copy_of_repo(tmp_path)
    if not keep_pipeline:
        (repo / "corpus_pipeline.py").unlink()
    code = RUN if not keep_pipeline else RUN.split("spark =")[0]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=repo, timeout=600)


def test_entry_without_a_library_of_the_subpackage():
    """A library that only the optional part needs is missing."""
    code = ("import sys; sys.modules['ahocorasick'] = None\n" + RUN.split("spark =")[0]).replace(' or n == "pipeline"', "")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, timeout=600)
