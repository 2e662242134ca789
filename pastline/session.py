"""Session helpers: a local session for tests/bench and the checkpoint folder.

Library operators never create sessions; they take DataFrames. Only tests,
the bench and the command-line tools call :func:`local_session`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pastline") -> SparkSession:
    """A local session configured the way the cluster job would be.

    AQE stays on (runtime coalescing, skew splits and size-checked broadcast
    conversion); the UI stays off.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PASTLINE_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the cluster configuration and read
    from the session. Only in a local session without one (tests, bench) is a
    fresh scratch folder created and registered; elsewhere that raises, since
    executors could not read a machine-local folder back.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="pastline-ckpt-", dir=os.environ.get("PASTLINE_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
