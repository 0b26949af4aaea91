"""The entry point without the training-data folders."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), sorted(set(e.oracle_sql()) - set(e.queries())))"


def listed(folder):
    done = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_entry_lists_the_other_queries_without_the_training_data_folders(tmp_path):
    for name in ("landledger", "tests"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path)
    from landledger.showcase import QUERIES

    assert listed(tmp_path) == [str(len(QUERIES)), "False", "[]"]
