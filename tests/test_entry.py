"""The entry module with and without the corpus operators, on copies of the repository."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print(len(e.queries()), *sorted(e.oracle_sql()))"


def copied(folder, *left_out):
    skip = {os.path.join(ROOT, x) for x in (*left_out, ".git")}

    def ignored(place, names):
        return [n for n in names if os.path.join(place, n) in skip or n == "__pycache__"]

    shutil.copytree(ROOT, folder, ignore=ignored)
    return folder


def said(folder):
    run = subprocess.run(
        [sys.executable, "-c", SAYS], cwd=folder, capture_output=True, text=True, timeout=120,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert run.returncode == 0, run.stderr
    number, *names = run.stdout.split()
    return int(number), names


@pytest.mark.parametrize("with_pipeline", [True, False])
@pytest.mark.parametrize("with_traces", [True, False])
def test_without_the_corpus_operators(tmp_path, with_pipeline, with_traces):
    """Also where their folder is left with compiled files only."""
    left_out = ["feedloom/llm", "tests/llm"] + ([] if with_pipeline else ["corpus_pipeline.py"])
    folder = copied(tmp_path / "copy", *left_out)
    if with_traces:
        (folder / "feedloom/llm/__pycache__").mkdir(parents=True)
    number, names = said(folder)
    assert number == len(names) and "edits" in names


def test_other_errors_of_the_corpus_operators_are_not_hidden(tmp_path):
    folder = copied(tmp_path / "copy")
    package = folder / "feedloom/llm"
    package.mkdir(parents=True, exist_ok=True)
    (package / "__init__.py").write_text("import a_module_that_is_not_there\n")
    with pytest.raises(AssertionError, match="a_module_that_is_not_there"):
        said(folder)
