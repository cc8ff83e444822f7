"""Small tables that say which files of a larger one count: written last, so that a reader sees all of a change or nothing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, path: str):
    """(file system, path) of the cluster's storage."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def mounted_at(spark: SparkSession, path: str) -> str | None:
    """Where a folder of files is found by all machines themselves; None if only Spark reaches it, or it is no folder."""
    system, place = _folder(spark, path)
    place = system.makeQualified(place)
    found = place.toUri().getScheme() == "file" and system.exists(place) and system.getFileStatus(place).isDirectory()
    return place.toUri().getPath() if found else None


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    system, place = _folder(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(place)) if system.exists(place) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    system, place = _folder(spark, path)
    system.delete(place, True)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete manifests."""
    found = [int(name[2:]) for name in children(spark, folder) if re.fullmatch(r"n=\d+", name)]
    return sorted(n for n in found if "_SUCCESS" in children(spark, f"{folder}/n={n}"))


def latest(spark: SparkSession, folder: str) -> tuple[int, list]:
    """(number, rows) of the newest complete manifest; (-1, []) if there is none. A manifest is small by design."""
    numbers = _numbers(spark, folder)
    return (numbers[-1], spark.read.parquet(f"{folder}/n={numbers[-1]}").collect()) if numbers else (-1, [])


def publish(rows: DataFrame, folder: str) -> int:
    """Write the next manifest as one file; it counts from the moment on at which it is complete. Only the last two stay."""
    spark = rows.sparkSession
    numbers = _numbers(spark, folder)
    number = numbers[-1] + 1 if numbers else 0
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/n={number}")
    for old in numbers[:-1]:
        delete_folder(spark, f"{folder}/n={old}")
    return number
