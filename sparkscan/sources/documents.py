"""Haystack tables: whole files and Parquet columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def whole_files(spark: SparkSession, path: str, *, binary: bool = False) -> DataFrame:
    """One row per file: ``(path, text)`` or ``(path, payload)``."""
    if binary:
        return spark.read.format("binaryFile").load(path).select("path", F.col("content").alias("payload"))
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_table(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return df.select(*columns) if columns else df
