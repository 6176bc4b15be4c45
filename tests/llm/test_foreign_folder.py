"""Every operator's query runs when the driver stands outside the repository and executors lack the package."""

import os
import subprocess
import sys
import tempfile

from wordtide.llm import registry

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
for name in {sorted(registry.QUERIES)!r}:
    E.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("DONE", name, flush=True)
"""


def test_all_operators_from_a_foreign_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE], cwd=tempfile.mkdtemp(prefix="wordtide-cwd-"), env=env, capture_output=True, text=True, timeout=1500)
    assert [x.split()[1] for x in out.stdout.splitlines() if x.startswith("DONE")] == sorted(registry.QUERIES), out.stderr[-3000:]
