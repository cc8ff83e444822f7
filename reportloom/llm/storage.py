"""Cutting lineage: intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..workspace import fresh_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as Parquet below `spark.checkpoint.dir` and read again.

    Later steps survive lost executors without computing `df` again. The folder is left to the cluster's
    clean-up of its checkpoint directory.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches_by_bytes(df: DataFrame, limit: str = "4m") -> None:
    """Let Arrow batches of this session hold `limit` bytes, so that long rows do not decide a worker's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", limit)
