"""Session helpers when the cluster names no checkpoint folder."""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from ontime.session import checkpoint_dir, scratch_path
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
a = checkpoint_dir(spark)
assert a and checkpoint_dir(spark) == a and spark.sparkContext.getCheckpointDir()
assert scratch_path(spark, "t").startswith(a)
q = entry.queries()
assert q["nearest_grid"](spark, {SF_SMALL!r}).count() == 779   # level checkpoints
assert q["worst_origins"](spark, {SF_SMALL!r}).count() == 20   # written model table
print("ok")
"""


def test_helpers_without_configured_checkpoint_dir():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="ontime-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().endswith("ok")
