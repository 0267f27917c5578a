"""Python workers must import the package even when the job runs outside the repo."""

import subprocess
import sys
import tempfile

from conftest import ROOT

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
from tessera.operators.ordered import running_sums
df = spark.range(0, 500).withColumn("one", F.lit(1))
out = running_sums(df, ["id"], ["one"]).agg(F.max("cum_one")).collect()[0][0]
print("MAXCUM", out)
spark.stop()
"""


def test_worker_import_from_foreign_cwd():
    r = subprocess.run([sys.executable, "-c", CODE], cwd=tempfile.mkdtemp(), capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "MAXCUM 500" in r.stdout
