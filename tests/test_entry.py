"""The entry module with and without the packages of the corpus operators."""

import importlib.util
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_sql_belongs_to_queries():
    spec = importlib.util.spec_from_file_location("entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.oracle_sql()) <= set(module.queries())


@pytest.mark.parametrize("absent", ["public_tokenizers", "tokenizers", "regex", "sentencepiece", "flowsift.llm"])
def test_other_queries_survive_a_missing_package(absent):
    code = (
        f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
        "q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, whole = done.stdout.split()
    assert int(count) >= 118 and whole == "True"
