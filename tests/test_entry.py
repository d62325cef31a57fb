"""The entry module where the subpackage of training-data operators cannot be imported."""

import os
import subprocess
import sys

from ledgerly.plans import registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys, warnings
sys.modules[{blocked!r}] = None
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as E
    print(len(E.queries()), len(E.oracle_sql()), sum("ledgerly.llm" in str(w.message) for w in said))
"""


def test_other_queries_stay_when_llm_cannot_be_imported():
    registry.load_all()
    for blocked in ("ahocorasick", "ledgerly.llm", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, check=True).stdout
        assert out.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLES)), "2"]
