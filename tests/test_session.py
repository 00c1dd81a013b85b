"""A session without ``spark.checkpoint.dir`` still runs checkpointing queries."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").getOrCreate()
s.sparkContext.setLogLevel("ERROR")
assert s.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
import __spark_entry__ as e
n = e.queries()["drift_chi2"](s, "/root/testdata/sf0.001").count()
print("RESULT", e.entry(s).count(), n)
"""


def test_runs_without_configured_checkpoint_dir():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="pintime-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True,
                         text=True, timeout=600)
    assert "RESULT 430 1" in out.stdout, out.stderr[-2000:]
