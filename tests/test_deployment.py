"""The similarity UDF must run when the driver starts outside the repository
(workers then cannot import the package; the kernel travels by value)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
from laborlens.functions.similarity import with_company_norm
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("Mahindra Techs",), ("Cyient Limited",), ("acme",)], "n string")
print(sorted(r.o for r in with_company_norm(df, "n", "o").collect()))
spark.stop()
"""


def test_udf_runs_from_foreign_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                             timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "['Acme', 'ITC Limited', 'Tech Mahindra']" in out.stdout
