"""The entry module with and without the corpus operators."""

import pathlib
import shutil
import subprocess
import sys

REPO = pathlib.Path(__file__).resolve().parent.parent


def test_entry_without_the_corpus_operators(tmp_path):
    shutil.copytree(REPO / "souk", tmp_path / "souk", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), set(e.oracle_sql()) <= set(q))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    n, corpus, covered = got.stdout.split()
    assert int(n) > 100 and corpus == "False" and covered == "True"


def test_nothing_else_imports_the_corpus_operators():
    for path in (REPO / "souk").rglob("*.py"):
        if "llm" not in path.parts:
            assert "souk.llm" not in path.read_text(), path
