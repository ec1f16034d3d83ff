"""The entry file without the subpackage on text corpora, or without packages that it needs."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT

BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == sys.argv[1]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
print(len(entry.queries()) == len(entry.core_queries()) > 50, set(entry.oracle_sql()) == set(entry.core_queries()))
"""


@pytest.mark.parametrize("name", ["corpus_pipeline", "orderlens.llm", "public_tokenizers", "tokenizers", "regex"])
def test_core_queries_stay(name):
    done = subprocess.run(
        [sys.executable, "-c", BLOCKED, name], env=os.environ | {"PYTHONPATH": ROOT},
        capture_output=True, text=True, timeout=120,
    )
    assert done.stdout.split() == ["True", "True"], done.stderr[-2000:]
