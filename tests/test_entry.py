"""The entry file in installations that leave out the training-data folder, its pipeline, or both."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def names(folder):
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder) + ":/opt"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return set(eval(done.stdout))


@pytest.mark.parametrize("gone", [["tapeworks/llm"], ["corpus_pipeline.py"], ["tapeworks/llm", "corpus_pipeline.py"]], ids=str)
def test_the_rest_imports_without(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=lambda folder, found: [
        x for x in found if x in (".git", "__pycache__", "tests") or os.path.relpath(os.path.join(folder, x), REPO) in gone
    ])
    left = names(copy)
    assert {"a08_bar", "t03_ticks", "q_dup"} <= left and "pipeline" not in left
    assert any(n.startswith("op") for n in left) == ("tapeworks/llm" not in gone)
