"""Session helpers: where data that must outlive an executor may be written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a shared folder")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
