"""Stacking, pivoting and unpivoting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def stack(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def widen_null(df: DataFrame, index: str, names: str, value: str, order: Sequence, prefix: str = "") -> DataFrame:
    """Long to wide, one column per entry of `order`; absent cells stay null.

    The list is always given, so no extra job has to look for the column names.
    """
    wide = df.groupBy(index).pivot(names, list(order)).agg(F.sum(value))
    return wide.withColumnsRenamed({str(v): f"{prefix}{v}" for v in order}) if prefix else wide


def widen(df: DataFrame, index: str, names: str, value: str, order: Sequence, prefix: str = "") -> DataFrame:
    """Long to wide with zero for absent cells."""
    return widen_null(df, index, names, value, order, prefix).na.fill(0)


def lengthen(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)
