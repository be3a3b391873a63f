"""Pandas UDFs must not need this package on the Python workers' path (the
driver may run from any folder): run them in a fresh process started in /tmp."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as E
q = E.queries()
n1 = q["user_filter_pandas"](spark, "/root/testdata/sf0.001").count()
n2 = q["sn_candidates_pandas_udf"](spark, "/root/testdata/sf0.001").count()
n3 = q["classify_pandas_udf"](spark, "/root/testdata/sf0.001").count()
print("COUNTS", n1, n2, n3)
spark.stop()
"""


def test_pandas_udfs_run_outside_repo():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="alertsieve-cwd-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "COUNTS 103 150 1000" in out.stdout, out.stderr[-3000:]
