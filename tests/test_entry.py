"""The entry points without the optional subpackage, or without what it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(k.startswith("op1_") for k in e.queries()))
"""


def entry(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)


@pytest.mark.skipif(not (ROOT / "finetide" / "llm").is_dir(), reason="the optional subpackage is absent")
def test_a_missing_package_costs_the_optional_queries_alone():
    found = entry(BLOCK.format(name="pyarrow_that_no_one_needs"))
    assert found.stdout.split()[2] == "True"
    without = entry(BLOCK.format(name="xxhash"))
    assert without.returncode == 0 and without.stdout.split()[2] == "False", without.stderr
    assert "left out" in without.stderr and int(without.stdout.split()[0]) >= 87


def test_missing_own_modules_are_errors():
    found = entry("import sys; sys.modules['registry.queries'] = None; import __spark_entry__")
    assert found.returncode != 0
