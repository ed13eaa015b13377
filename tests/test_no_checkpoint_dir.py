"""A session started without spark.checkpoint.dir (a fresh JVM, in a
subprocess: the setting is fixed when the context starts)."""

import os
import subprocess
import sys
import tempfile

from .conftest import REPO, SF_SMOKE

SCRIPT = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
import __spark_entry__ as e
from medalla.config import checkpoint_root
assert e.queries()["employee_history"](spark, "{SF_SMOKE}").count() > 0
assert e.queries()["sales_stream_rejects"](spark, "{SF_SMOKE}").count() > 0
assert checkpoint_root(spark) == checkpoint_root(spark)
print("OK")
"""


def test_runs_without_a_configured_checkpoint_dir():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="noconf-"), PYTHONPATH=REPO)
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=600, cwd=REPO)
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-3000:]
