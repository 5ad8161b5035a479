"""The driver imports __spark_entry__ from elsewhere with its own session:
queries must run from any working directory, including the ones whose code
runs in Python workers."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
import __spark_entry__ as E
assert E.entry(spark).count() > 0
for key in ("exact_topk", "ann_topk", "biased_topk"):
    assert E.queries()[key](spark, "/root/testdata/sf0.001").count() > 0, key
print("CONTRACT-OK")
"""


def test_queries_run_from_another_directory():
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd="/tmp", capture_output=True, text=True,
                         timeout=600)
    assert "CONTRACT-OK" in out.stdout, out.stderr[-3000:]
