"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "subledger",
                  shuffle_partitions: int | None = None, local_memory: str = "12g") -> SparkSession:
    """Session with AQE on, UTC clock and no UI.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count then stays whatever the cluster configured.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # one machine, small test tables: let AQE keep shuffle partitions of ~64 KB
        # instead of merging every small shuffle into a single task; in local mode
        # the driver JVM is also the executor, so give it a real heap
        builder = (builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
                   .config("spark.driver.memory", local_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when none is set.

    A cluster names a shared folder in ``spark.checkpoint.dir`` and Spark applies
    it when the context starts; that folder is used as is. Only a local session
    without one (tests) gets a fresh temp folder, through the context API (the
    config itself cannot be changed at run time); on a cluster a missing folder
    is an error, since no machine's own folder reaches the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="subledger-ckpt-"))
        current = sc.getCheckpointDir()
    return current


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for a job's written tables."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
