"""The entry without the optional text operators: the driver may delete them, with or without the pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries(), any(k.startswith('op') for k in e.queries()))"


@pytest.mark.parametrize("pipeline_too", [False, True])
@pytest.mark.parametrize("left_over", [False, True])
def test_entry_without_the_text_operators(tmp_path, pipeline_too, left_over):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    if left_over:  # an empty folder, as an editor or a cache leaves it
        (copy / "partwise" / "llm" / "__pycache__").mkdir(parents=True)
    if pipeline_too:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    said = subprocess.run([sys.executable, "-B", "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    assert said.stdout.split() == ["108", "108", "False", "False"]


def test_a_fault_inside_an_operator_is_not_hidden(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (copy / "partwise" / "llm").mkdir()
    (copy / "partwise" / "llm" / "__init__.py").touch()
    (copy / "partwise" / "llm" / "queries.py").write_text("import a_module_that_is_not_there\n")
    said = subprocess.run([sys.executable, "-B", "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert said.returncode != 0 and "a_module_that_is_not_there" in said.stderr
