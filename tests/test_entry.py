import importlib.util
import subprocess
import sys

import pytest
from conftest import ROOT

#: The subpackage and its pipeline as if their files were gone.
WITHOUT = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "{gone}" or name.startswith("{gone}."):
            raise ModuleNotFoundError(f"No module named '{gone}'", name="{gone}")
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = e.queries()
assert "c8_clean" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
assert set(e.oracle_sql()) <= set(names)
"""


def run(code):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_entry_without_the_document_operators():
    for gone in ("corpus_health.llm", "corpus_pipeline"):
        done = run(WITHOUT.format(gone=gone))
        assert done.returncode == 0, done.stderr


@pytest.mark.skipif(importlib.util.find_spec("corpus_health.llm") is None, reason="nothing that imports it")
def test_a_missing_dependency_costs_the_document_operators_only():
    """The other queries stay, and a warning names what is missing."""
    done = run(WITHOUT.format(gone="xxhash"))
    assert done.returncode == 0, done.stderr
    assert "No module named 'xxhash'" in done.stderr
