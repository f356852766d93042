"""The entry module without the training-data subpackage or what it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), sum(n.startswith("op") for n in entry.queries()), set(entry.queries()) == set(entry.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["xxhash", "midyear.llm", "corpus_pipeline"])
def test_entry_without(name):
    out = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    queries, numbered, covered = out.stdout.split()
    assert int(queries) > 100 and numbered == "0" and covered == "True"
