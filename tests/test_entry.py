"""The driver's functions in a copy of the repository that lacks the ``llm`` subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_llm(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "stratavault", copy / "stratavault", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", *(["corpus_pipeline.py"] if pipeline and (ROOT / "corpus_pipeline.py").exists() else [])):
        shutil.copy(ROOT / name, copy)
    code = ("import __spark_entry__ as e, bench; names = set(e.queries()); assert set(e.oracle_sql()) <= names and set(bench.HEADLINE) <= names; "
            "assert not any(n.startswith('op') or n == 'pipeline' for n in names), names; print(len(names))")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 100
