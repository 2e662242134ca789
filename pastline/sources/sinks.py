"""Sinks and stage tables.

Stage tables and design matrices go to a shared folder (by default under
the cluster's ``spark.checkpoint.dir``), written once and read back with
partition pruning. Never a machine-local folder on a cluster.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.session import ensure_checkpoint_dir


def stage_root(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "stages", spark.sparkContext.applicationId, name)


def write_stage(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """One parquet write; ``partition_by='split'`` gives one folder per split."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read a split-partitioned stage; the filter prunes folders."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """A table as CSV with a header; ``single`` puts a small result into one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)
