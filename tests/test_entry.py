"""The entry imports with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("emptied", [False, True])
def test_entry_without_the_training_data_operators(tmp_path, emptied):
    """Also where only the folder is left, as caches do."""
    for name in ("__spark_entry__.py", "workload", "tonetape"):
        copy = shutil.copytree if (ROOT / name).is_dir() else shutil.copy
        skip = {"ignore": shutil.ignore_patterns("llm", "__pycache__")} if (ROOT / name).is_dir() else {}
        copy(ROOT / name, tmp_path / name, **skip)
    # The pipeline may still lie beside the entry.
    (tmp_path / "corpus_pipeline.py").write_text("import tonetape.llm.copies\n")
    if emptied:
        (tmp_path / "tonetape" / "llm").mkdir()
    run = "import __spark_entry__ as e; n = e.queries(); assert n and set(e.oracle_sql()) <= set(n); print('pipeline' in n)"
    got = subprocess.run([sys.executable, "-c", run], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    assert got.stdout.split()[-1] == "False"
