"""The driver's entry with and without the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCKED = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(n[:2] == "op" and n[2:3].isdigit() for n in entry.queries()))
"""


def imported_without(name):
    code = BLOCKED.format(name=name)
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("name", ["epiledger.llm", "corpus_pipeline", "public_tokenizers", "xxhash", "numpy"])
def test_the_rest_survives_what_only_the_optional_part_needs(name):
    from verification.oracles import ORACLES
    from verification.queries import QUERIES

    found = imported_without(name)
    assert found.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"], found.stderr[-500:]


def test_a_library_module_that_is_missing_is_raised():
    assert imported_without("epiledger.sources.shared").returncode != 0
