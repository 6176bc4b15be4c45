"""UDF queries work when the driver runs outside the repo folder (executors do not
have the package on their path; its UDFs are pickled by value)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ["t3_document_terms", "s7_page_posts", "w6_binomial_ci"]:
    print("ROWS", name, E.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_udf_queries_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="wordtide-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=900)
    rows = [l.split() for l in out.stdout.splitlines() if l.startswith("ROWS ")]
    assert out.returncode == 0, out.stderr[-3000:]
    assert [r[1] for r in rows] == ["t3_document_terms", "s7_page_posts", "w6_binomial_ci"]
    assert all(int(r[2]) > 0 for r in rows)
