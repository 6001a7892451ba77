"""Sessions without a configured checkpoint folder still get one (as local tests need)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.sparkContext.getCheckpointDir() is None
from subledger.functions.lineage import cut
from subledger.session import ensure_checkpoint_dir
assert ensure_checkpoint_dir(spark)
assert cut(spark.range(5)).count() == 5
print("ok")
"""


def test_checkpoint_folder_when_unset(tmp_path):
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))  # no spark-defaults.conf
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("ok"), out.stderr[-2000:]


def test_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace as Some

    import pytest

    from subledger.session import ensure_checkpoint_dir
    context = Some(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: Some(get=lambda key, default: default))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Some(sparkContext=context))
