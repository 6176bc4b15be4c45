"""The entry module works without the optional training-data operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules["corpus_pipeline"] = None  # importing it now raises ImportError
import __spark_entry__ as e
names = set(e.queries())
assert len(names) >= 50 and set(e.oracle_sql()) == names, names ^ set(e.oracle_sql())
assert not any(n.startswith("op") or n == "pipeline" for n in names)
"""


def test_queries_without_optional_operators():
    env = os.environ | {"PYTHONPATH": ROOT}
    subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, env=env, check=True, timeout=120)
