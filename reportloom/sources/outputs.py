"""Tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def output_path(base: str, label: str, name: str) -> str:
    return f"{base}/outputs_{label}/{name}"


def write_output(df: DataFrame, base: str, label: str, name: str, fmt: str = "csv") -> str:
    """Overwrite `outputs_<label>/<name>` with part files: CSV with header, or Parquet."""
    path = output_path(base, label, name)
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)
    return path


def write_labelled(df: DataFrame, path: str, label: str = "label") -> str:
    """The internal form of the same idea: one Parquet table, one partition per label.

    Rebalancing brings a label's rows together and lets AQE split a label that holds very many.
    """
    df.hint("rebalance", F.col(label)).write.mode("overwrite").partitionBy(label).parquet(path)
    return path


def export_parts(df: DataFrame, path: str, *order: str) -> str:
    """Comma-separated download with headers as part files written in parallel, in range order on request."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_single(df: DataFrame, path: str, *order: str) -> str:
    """The same as one file. All rows pass through one task: for summaries that a person downloads.

    They are brought together by a shuffle, which leaves the work before it parallel.
    """
    out = df.repartition(1)
    out = out.sortWithinPartitions(*order) if order else out
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_vectors(df: DataFrame, path: str) -> str:
    """Rebuild the vector table from scratch."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_feed(items: DataFrame, path: str, order: str, *tie_break: str, newest: int | None) -> str:
    """Publish items as feed files, newest first: the `newest` ones in one file, or with None all of them, in parallel."""
    ranked = items.orderBy(F.col(order).desc_nulls_last(), *tie_break)
    out = ranked if newest is None else ranked.limit(newest).coalesce(1)
    out.write.mode("overwrite").format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return path
