"""The entry points without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

LIST = "import __spark_entry__ as e; from corpusloom.plans import catalog; print(sorted(set(e.queries()) - set(catalog.QUERIES)))"


@pytest.mark.parametrize("missing", [["corpusloom/llm"], ["corpus_pipeline.py"], ["corpusloom/llm", "corpus_pipeline.py"]])
def test_core_queries_stay(tmp_path, missing):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in missing and (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    left_out = [Path(m).name for m in missing]
    shutil.copytree(ROOT / "corpusloom", tmp_path / "corpusloom", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    done = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "pipeline" not in done.stdout


def test_other_errors_are_not_hidden(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "corpusloom", tmp_path / "corpusloom", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    (tmp_path / "corpus_pipeline.py").write_text("import not_a_module\n")
    done = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "not_a_module" in done.stderr
