"""The entry point with and without the optional training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def ask(folder):
    run = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, check=True)
    n_queries, n_sql, has_pipeline = run.stdout.split()
    return int(n_queries), int(n_sql), has_pipeline == "True"


@pytest.mark.parametrize("with_pipeline_file", [True, False])
def test_entry_without_the_optional_part(tmp_path, with_pipeline_file):
    from checks.duck_sql import SQL
    from checks.spark_queries import QUERIES

    copy = tmp_path / "copy"
    copy.mkdir()
    for name in ("clipsieve", "checks"):
        shutil.copytree(ROOT / name, copy / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *["corpus_pipeline.py"] * with_pipeline_file):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, copy / name)
    assert ask(copy) == (len(QUERIES), len(SQL), False)


def test_entry_with_everything_that_is_there():
    from checks.spark_queries import QUERIES

    n_queries, _, has_pipeline = ask(ROOT)
    assert has_pipeline == (n_queries > len(QUERIES))
