"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.documents import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "documents", "doc_id", "text")


def conversations(spark: SparkSession, directory: str) -> DataFrame:
    """Conversations as streams: one per conversation, one chunk per turn."""
    rows = read_table(spark, directory, "conversations", "conv_id", "turn", "text")
    return rows.withColumnsRenamed({"conv_id": "stream_id", "turn": "seq", "text": "payload"})
