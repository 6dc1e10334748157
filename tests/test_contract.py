"""The driver contract holds with and without the corpus subpackage and its pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as c; print(*sorted(c.queries())); assert set(c.oracle_sql()) <= set(c.queries())"


def names(root):
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


@pytest.mark.parametrize("left_out", [["llm"], ["llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_import_without_corpus_parts(tmp_path, left_out):
    root = tmp_path / "copy"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *left_out))
    found = names(root)
    corpus = {n for n in found if n.startswith("op") and n[2].isdigit()}
    assert bool(corpus) == ("llm" not in left_out)
    assert "pipeline" not in found
    assert {"engagement_rotation", "max_sharpe_weights"} <= found


def test_rest_does_not_import_corpus_parts():
    for path in (ROOT / "marketseries").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
