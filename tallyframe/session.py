"""Session set-up and the shared folder used for written state."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the session it gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyframe")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "localhost")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine; a cluster
    without the setting is an error, since its executors would not share that folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyframe-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
