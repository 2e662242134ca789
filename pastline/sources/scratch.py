"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from pastline.session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage and keeps nothing in executor memory: readers of the
    result share one computation, and a lost executor costs none of it.
    """
    spark = df.sparkSession
    path = (f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-scratch/"
            f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
