"""Every operator's query runs where Python workers don't find the package: a fresh process started elsewhere."""

import os
import subprocess
import sys
import tempfile

from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
for name, query in E.queries().items():
    if name.startswith("op"):
        print("DONE", name, query(spark, {SF001!r}).count())
spark.stop()
"""


def test_queries_run_outside_repo():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="alertsieve-cwd-"), env=env,
                         capture_output=True, text=True, timeout=900)
    done = {line.split()[1].split("_")[0] for line in out.stdout.splitlines() if line.startswith("DONE")}
    assert done == {f"op{n}" for n in range(1, 14)}, out.stderr[-3000:]
