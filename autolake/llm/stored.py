"""Intermediate tables in the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from autolake.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
