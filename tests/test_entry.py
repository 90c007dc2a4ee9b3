"""The entry points, whole and without the optional folder or a package that only it needs."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q), *q)"


def names(folder, prelude=""):
    run = subprocess.run(
        [sys.executable, "-W", "ignore", "-c", prelude + NAMES], cwd=folder, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0, run.stderr
    return set(run.stdout.split()[1:])


def test_the_rest_lives_without_the_optional_folder(tmp_path):
    from brightmere.plans import QUERIES

    copy = tmp_path / "copy"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    assert names(copy) == set(QUERIES)
    if os.path.exists(os.path.join(HERE, "corpus_pipeline.py")):
        shutil.copy(os.path.join(HERE, "corpus_pipeline.py"), copy)
        assert names(copy) == set(QUERIES)


@pytest.mark.parametrize("package", ["zstandard", "ahocorasick"])
def test_the_rest_lives_without_a_package(package):
    from brightmere.plans import QUERIES

    assert set(QUERIES) <= names(HERE, f"import sys; sys.modules[{package!r}] = None; ")
