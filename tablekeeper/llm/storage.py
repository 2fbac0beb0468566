"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablekeeper.session import scratch_path


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The same rows, written below the folder in spark.checkpoint.dir and read again: lineage ends there."""
    path = scratch_path(frame.sparkSession, f"llm-{label}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

