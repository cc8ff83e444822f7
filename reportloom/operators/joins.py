"""Joins to dimensions, semi joins and dense grids.

No join here is hinted except on sides whose size is bounded by construction: Catalyst picks
broadcast from statistics, and AQE splits skewed partitions of the sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .ranking import top_k

# Residents per province or territory, in thousands.
PROVINCE_POPULATION = (
    ("Ontario", 15608.0),
    ("Quebec", 8751.0),
    ("British Columbia", 5519.0),
    ("Alberta", 4756.0),
    ("Manitoba", 1431.0),
    ("Saskatchewan", 1204.0),
    ("Nova Scotia", 1066.0),
    ("New Brunswick", 834.0),
    ("Newfoundland and Labrador", 533.0),
    ("Prince Edward Island", 173.0),
    ("Northwest Territories", 45.0),
    ("Yukon", 43.0),
    ("Nunavut", 40.0),
)


def literal_dim(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def province_population(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, PROVINCE_POPULATION, "province string, population double")


def left_dim(df: DataFrame, dim: DataFrame, *keys: str) -> DataFrame:
    """Every row stays; unknown keys get nulls."""
    return df.join(dim, list(keys), "left")


def inner_on(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    return left.join(right, list(keys), "inner")


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Add one dimension value under a new name; missing keys give null."""
    return df.join(dim.select(key, F.col(value).alias(name)), key, "left")


def semi_topk(df: DataFrame, key: str, totals: DataFrame, measure: str, k: int) -> DataFrame:
    """Rows of `df` whose key is among the k largest of `totals`.

    The right side has at most k rows by construction, so it is safe to broadcast. A null key can
    take one of the k places and then selects nothing.
    """
    return df.join(F.broadcast(top_k(totals, measure, k, key).select(key)), key, "left_semi")


def grid(left: DataFrame, right: DataFrame, cells: int = 1_000_000) -> DataFrame:
    """Every combination of two level lists: |left| x |right| rows are the result by definition.

    It is an equi-join over tiles. Each side is hashed into tiles and copied along the other axis, with so many
    tiles (from the two counts) that one makes about `cells` rows; neither list passes through one task.
    """
    sizes = left.agg(F.count("*")).scalar() * right.agg(F.count("*")).scalar()
    tiles = F.greatest(F.lit(1), F.ceil(F.sqrt(sizes / F.lit(cells)))).cast("int")
    axis = F.sequence(F.lit(0), tiles - 1)
    tile = lambda side: F.pmod(F.hash(*side.columns), tiles)
    rows = left.withColumn("_i", tile(left)).withColumn("_j", F.explode(axis))
    cols = right.withColumn("_j", tile(right)).withColumn("_i", F.explode(axis))
    return rows.join(cols, ["_i", "_j"]).drop("_i", "_j")


def levels(counts: DataFrame, key: str, measure: str = "n") -> DataFrame:
    """Levels that occur in a table of counts.

    Testing the summed count keeps Catalyst from going back to the base table for them, so the
    shuffle of the counts is reused.
    """
    return counts.groupBy(key).agg(F.sum(measure).alias("_n")).filter("_n > 0").select(key)


def complete(counts: DataFrame, a: str, b: str, measure: str = "n") -> DataFrame:
    """Dense two-way table: all (a, b) level pairs, zero where the pair does not occur.

    Call it on counts, not on raw rows. The output has |a| x |b| rows by definition.
    """
    pairs = grid(levels(counts, a, measure), levels(counts, b, measure))
    return pairs.join(counts, [a, b], "left").withColumn(measure, F.coalesce(measure, F.lit(0)))
