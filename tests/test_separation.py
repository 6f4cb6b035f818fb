"""The entry points without the text operators, or without the libraries that only they need."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LISTING = """
import sys
sys.path.insert(0, {root!r})
for name in {hidden!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
from earshot.registered.spark_queries import QUERIES
assert entry.queries().keys() >= QUERIES.keys() == entry.ORACLE_SQL.keys()
print(len(entry.queries()) - len(QUERIES), len(entry.oracle_sql()) - len(QUERIES))
"""


def listed(root: Path, *hidden: str) -> list[int]:
    """How many queries and statements there are beyond the recommender's."""
    code = LISTING.format(root=str(root), hidden=hidden)
    out = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, cwd=root, check=False
    )
    assert not out.returncode, out.stderr
    return [int(n) for n in out.stdout.split()]


@pytest.fixture
def copied(tmp_path):
    """The repository without the text operators; the pipeline's file stays behind."""
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    shutil.copytree(
        ROOT / "earshot", tmp_path / "earshot", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    return tmp_path


def test_without_the_folders(copied):
    assert listed(copied) == [0, 0]


def test_without_the_pipeline_too(copied):
    (copied / "corpus_pipeline.py").unlink(missing_ok=True)
    assert listed(copied) == [0, 0]


def test_an_empty_folder_left_behind(copied):
    (copied / "earshot" / "llm").mkdir()
    assert listed(copied) == [0, 0]


@pytest.mark.parametrize("library", ["xxhash", "tokenizers", "public_tokenizers"])
def test_without_a_library_of_theirs(library):
    assert listed(ROOT, library) == [0, 0]


def test_a_fault_of_our_own_is_not_hidden(copied):
    (copied / "earshot" / "llm").mkdir()
    (copied / "earshot" / "llm" / "registered.py").write_text("import earshot.llm.absent")
    with pytest.raises(AssertionError, match="earshot.llm.absent"):
        listed(copied)
