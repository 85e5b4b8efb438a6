"""The library and its entry work without the subpackage of training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import __spark_entry__ as e
names, sql = set(e.queries()), set(e.oracle_sql())
assert sql <= names and "page_extract" in names, names
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
import pkgutil, importlib, corpusmill
for m in pkgutil.walk_packages(corpusmill.__path__, "corpusmill."):
    if not m.name.endswith("__main__"):
        importlib.import_module(m.name)
"""


@pytest.mark.parametrize("pipeline", [True, False])
@pytest.mark.parametrize("leftover", [True, False])
def test_without_the_subpackage(tmp_path, pipeline, leftover):
    skip = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    for folder in ("corpusmill/llm", "tests/llm"):
        shutil.rmtree(tmp_path / "copy" / folder, ignore_errors=True)
    if leftover:  # a folder of compiled files may stay
        os.makedirs(tmp_path / "copy/corpusmill/llm/__pycache__")
    if not pipeline:
        (tmp_path / "copy/corpus_pipeline.py").unlink(missing_ok=True)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_it():
    for top, _, names in os.walk(os.path.join(ROOT, "corpusmill")):
        if os.path.join("corpusmill", "llm") not in top:
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(top, name), encoding="utf-8") as f:
                        assert "corpusmill.llm" not in f.read(), name
