"""The library stands without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'scored_predictions' in q and set(s) <= set(q) and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q)"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_corpus(tmp_path, pipeline):
    shutil.copytree(ROOT / "fleetlens", tmp_path / "fleetlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * (pipeline and (ROOT / "corpus_pipeline.py").exists())]:
        shutil.copy(ROOT / name, tmp_path / name)
    subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, check=True, timeout=120)
