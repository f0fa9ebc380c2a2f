"""The driver's module with and without the training-data add-on."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"


def test_imports_without_the_add_on(tmp_path):
    """With its folders deleted and the pipeline deleted or left behind."""
    from ringlake.registry import QUERIES

    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "with-pipeline", ignore=skip)
    shutil.copytree(tmp_path / "with-pipeline", tmp_path / "without", ignore=shutil.ignore_patterns("corpus_pipeline.py"))
    for folder in ("with-pipeline", "without"):
        env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
        out = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path / folder, env=env, capture_output=True, text=True, check=True)
        assert out.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"]
