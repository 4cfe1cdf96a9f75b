"""Tasks do not need this package: a session whose workers cannot import it runs every Python operator."""

import os
import subprocess
import sys

CODE = """
import os, sys
root = sys.argv[1]
sys.path.insert(0, root)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", sys.argv[2]).getOrCreate())
from stride.llm import queries as Q
d = "/root/testdata/sf0.001"
for name in ("op1_quality_rules", "op3_language_id", "op4_minhash_neardup", "op5_packing", "op6_toxicity", "op10_span_dedup"):
    assert Q.QUERIES[name](spark, d).count() > 0
print("ALL RAN")
"""


def test_workers_without_the_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE, root, str(tmp_path / "shared")], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=600)
    assert "ALL RAN" in done.stdout, done.stderr[-2000:]
