"""The registered queries without the document operators, and with broken ones."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), len(e.REGISTRY))"


@pytest.fixture
def copy(tmp_path):
    for name in ("__spark_entry__.py", "oracles.py"):
        shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "fareloom", tmp_path / "fareloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return tmp_path


def imported(folder):
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)


def test_without_the_document_operators(copy):
    done = imported(copy)
    queries, oracles, registered = map(int, done.stdout.split())
    assert queries == oracles == registered > 50


def test_a_pipeline_without_its_operators_is_absent_too(copy):
    (copy / "corpus_pipeline.py").write_text("from fareloom.llm import common\n")
    assert len(set(imported(copy).stdout.split())) == 1


@pytest.mark.parametrize("fault", ["import no_such_library", "from fareloom.sources import no_such_name", "1 / 0"])
def test_a_broken_operator_raises(copy, fault):
    (copy / "fareloom" / "llm").mkdir()
    (copy / "fareloom" / "llm" / "__init__.py").write_text("")
    (copy / "fareloom" / "llm" / "registry.py").write_text(fault + "\n")
    (copy / "corpus_pipeline.py").write_text("ORACLE_SQL = None\n")
    done = imported(copy)
    assert done.returncode != 0 and "Error" in done.stderr
