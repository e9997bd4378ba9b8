"""The entry works without the training-data package, and without what that needs."""

import importlib.util
import subprocess
import sys

import pytest

from conftest import ROOT

INSTALLED = importlib.util.find_spec("stratamill.llm") is not None


@pytest.mark.parametrize("absent", ["stratamill.llm", "pyarrow", "corpus_pipeline"])
def test_entry_without(absent):
    code = f"""
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {absent!r} or name.startswith({absent!r} + "."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Absent())
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
names = entry.queries()
assert {{"txn_by_minute", "master_load_buckets"}} <= set(names) and set(entry.oracle_sql()) <= set(names)
assert "pipeline" not in names
assert any(n.startswith("op1_") for n in names) == ({absent!r} == "corpus_pipeline" and {INSTALLED})
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
