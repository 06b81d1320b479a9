"""The driver contract in a tree without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as E; from weatherlake.plans import REGISTRY as R; assert set(E.queries()) == set(R) == set(E.oracle_sql())"


@pytest.mark.parametrize("pipeline", [True, False])
def test_works_without_the_subpackage(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(HERE, tmp_path / "copy", ignore=left_out)
    run = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path / "copy", capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stderr


def test_a_broken_import_is_not_an_absent_one(tmp_path):
    shutil.copytree(HERE, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache"))
    (tmp_path / "copy" / "corpus_pipeline.py").write_text("import no_such_module_of_ours\n")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as E; E.queries()"], cwd=tmp_path / "copy",
                         capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.returncode != 0 and "no_such_module_of_ours" in run.stderr
