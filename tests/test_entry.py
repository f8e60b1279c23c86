"""The registry without the training-data folder, or with a folder whose files are gone."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(q) == set(o); print(len(q))"


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "compiled files"])
def test_planning_queries_stand_without_the_training_data(tmp_path, left):
    ignored = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(ROOT, "monthplan"), tmp_path / "monthplan", ignore=ignored, copy_function=shutil.copyfile)
    shutil.copyfile(os.path.join(ROOT, "__spark_entry__.py"), tmp_path / "__spark_entry__.py")
    folder = tmp_path / "monthplan" / "llm"
    if left != "nothing":
        folder.mkdir()
    if left == "compiled files":
        (folder / "__pycache__").mkdir()
        (folder / "__pycache__" / "queries.cpython-313.pyc").write_bytes(b"")
        (tmp_path / "corpus_pipeline.py").write_text("from monthplan.llm import packing")
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([str(tmp_path), os.environ.get("PYTHONPATH", "")])}
    run = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) == 47
