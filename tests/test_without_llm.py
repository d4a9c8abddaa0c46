"""The library and its entry work where the training-data folders were
removed, with or without the pipeline's module beside them."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_entry_without_the_training_data_folders(tmp_path, keep_pipeline):
    import json

    from skyfold.plans import oracle, queries

    copy = tmp_path / "copy"
    gone = {".git", "__pycache__", "llm"} | (set() if keep_pipeline else {"corpus_pipeline.py"})
    shutil.copytree(ROOT, copy, ignore=lambda _, names: gone & set(names))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", LIST], cwd=copy, env=env, capture_output=True, text=True, check=True)
    names = json.loads(out.stdout.splitlines()[-1])
    assert names == [sorted(queries.queries()), sorted(oracle.oracle_sql())]


def test_nothing_outside_imports_the_training_data_package():
    for folder, _, files in os.walk(os.path.join(ROOT, "skyfold")):
        for name in files:
            if name.endswith(".py") and "llm" not in os.path.relpath(folder, ROOT).split(os.sep):
                with open(os.path.join(folder, name)) as f:
                    assert "skyfold.llm" not in f.read(), name
