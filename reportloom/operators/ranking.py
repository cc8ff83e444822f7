"""Sorting, top-k and paging."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def order_periods(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*keys)


def rank_desc(df: DataFrame, measure: str, *tie_break: str, ascending: bool = False) -> DataFrame:
    first = F.col(measure).asc_nulls_last() if ascending else F.col(measure).desc_nulls_last()
    return df.orderBy(first, *tie_break)


def top_k(df: DataFrame, measure: str, k: int, *tie_break: str) -> DataFrame:
    """Runs as TakeOrderedAndProject: each task keeps k rows, only those travel."""
    return rank_desc(df, measure, *tie_break).limit(k)


def sample_head(df: DataFrame, *order: str, n: int = 6) -> DataFrame:
    """First n rows under an explicit order."""
    return df.orderBy(*order).limit(n)


def recent(df: DataFrame, day: str, *tie_break: str) -> DataFrame:
    return df.orderBy(F.col(day).desc_nulls_last(), *tie_break)


def page(df: DataFrame, order: Sequence, number: int, size: int = 10) -> DataFrame:
    """Page `number` (from 1). Cost grows with the page number; walk deep tables with `page_after` or `read_page`."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence | None, size: int = 10) -> DataFrame:
    """The page behind the row whose (non-null, ascending) keys are `last`; cost is the same at any depth."""
    if last is not None:
        behind = []
        for i, name in enumerate(keys):
            same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], last[:i])]
            behind.append(reduce(and_, same + [F.col(name) > F.lit(last[i])]))
        df = df.filter(reduce(or_, behind))
    return df.orderBy(*keys).limit(size)


def write_pages(df: DataFrame, order: Sequence, path: str) -> None:
    """Sort a table once for paging: its rows with their range and their place in it, and a directory of the ranges.

    Ranges are sorted in parallel; the directory has a row per range, with the number of rows before it. `order` should
    tell all rows apart, as any order of equal rows may be kept. What is below `path` is replaced.
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()  # range in the upper bits, place in the lower 33
    ordered.select("*", number.alias("_number")).selectExpr(
        *[f"`{c}`" for c in df.columns], "shiftright(_number, 33) AS _range", "_number & 8589934591 AS _place"
    ).write.mode("overwrite").parquet(f"{path}/rows")
    sizes = spark.read.parquet(f"{path}/rows").groupBy("_range").agg(F.count("*").alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/directory")


def read_page(spark: SparkSession, path: str, number: int, size: int = 10) -> DataFrame:
    """Page `number` (from 1) of a table by `write_pages`: reads the row groups that hold it, at any depth."""
    first, end = (number - 1) * size, number * size
    table = spark.read.parquet(f"{path}/rows")
    held = spark.read.parquet(f"{path}/directory").filter((F.col("start") < end) & (F.col("start") + F.col("n") > first)).collect()
    places = [
        (F.col("_range") == r["_range"]) & (F.col("_place") >= first - r["start"]) & (F.col("_place") < end - r["start"]) for r in held
    ]
    return table.filter(reduce(or_, places, F.lit(False))).orderBy("_range", "_place").drop("_range", "_place")
