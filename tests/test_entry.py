"""What the entry module offers where the training-data operators can't be imported."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tallystream.plans.oracles import ORACLES
from tallystream.plans.queries import QUERIES

SCRIPT = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {blocked!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("blocked", ["public_tokenizers", "sentencepiece", "tallystream.llm"])
def test_queries_without_a_package(blocked):
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=entry.REPO, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"], run.stderr
