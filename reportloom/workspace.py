"""Where intermediate tables, stream checkpoints and exports go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in `spark.checkpoint.dir`.

    A machine-local folder is used only when the setting is absent *and* the session is local,
    which is the case in tests; on a cluster a missing setting is an error.
    """
    global _local_base
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="reportloom-")
    return _local_base


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder (Spark creates it on first write)."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table below the shared folder: computed once, also when executors are lost afterwards."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
