"""The driver contract stands without the training-data operators or a library that only they need."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
print(len(q), sum(n.startswith("op") or n == "pipeline" for n in q), set(o) <= set(q), "F2_top_bow_terms" in q)
"""


def counts(*blocked):
    out = subprocess.run([sys.executable, "-c", COUNT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    total, llm, oracles, flagship = out.split()
    assert oracles == flagship == "True"
    return int(total), int(llm)


def test_queries_without_a_library_of_the_training_data_operators():
    total, llm = counts()
    assert counts("zstandard") == (total - llm, 0)
    assert counts("veracorp.llm") == counts("corpus_pipeline") == (total - llm, 0)
    assert total - llm >= 159
