"""The entry imports and answers with parts of the tree missing."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *sorted(e.queries()))"


def names(folder, before=""):
    out = subprocess.run([sys.executable, "-c", before + LIST], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()[2:]


@pytest.mark.parametrize("gone", [(), ("corpus_pipeline.py",), ("tallybook/llm",), ("tallybook/llm", "corpus_pipeline.py")])
def test_entry_without_the_training_data_part(tmp_path, gone):
    copy = tmp_path / "tree"
    shutil.copytree(ROOT, copy, ignore=lambda folder, found: [
        n for n in found if n in (".git", "tests", "spark-warehouse", "__pycache__") or (Path(folder) / n).relative_to(ROOT).as_posix() in gone])
    found = names(copy)
    there = [(copy / p).exists() for p in ("tallybook/llm", "corpus_pipeline.py")]
    assert "statement_kpis" in found
    assert any(n.startswith("op1_") for n in found) == there[0] and ("pipeline" in found) == all(there)


def test_entry_without_what_the_training_data_part_needs():
    found = names(ROOT, "import sys; sys.modules['numpy'] = None; sys.modules['pyarrow'] = None\n")
    assert "statement_kpis" in found and "pipeline" not in found
