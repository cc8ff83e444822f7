"""Regional reports: specialisation heat table, per-capita ranking, deep dive into one region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import label_if, rate_per
from ..operators.aggregates import contribution, cross_freq, freq, rate_ratio
from ..operators.filters import keep_in, matches, not_like, slice_rows
from ..operators.joins import grid
from ..operators.ranking import rank_desc, top_k
from ..operators.windows import row_pct

# Names of the two sides of a rate ratio of one.
ABOVE, BELOW = "Above National", "Below National"


def heat_table(df: DataFrame, a: str = "province", b: str = "fraud_cat", top_a: int = 8, top_b: int = 10) -> DataFrame:
    """Dense counts and row percentages of the largest `a` levels against the largest `b` levels.

    Percentages are over all `b` levels; the choice of levels comes after.
    """
    cells = cross_freq(df, a, b)
    rows = top_k(cells.groupBy(a).agg(F.sum("n").alias("total")), "total", top_a, a).select(a)
    cols = top_k(cells.groupBy(b).agg(F.sum("n").alias("total")), "total", top_b, b).select(b)
    return grid(rows, cols).join(row_pct(cells, a), [a, b], "left").na.fill(0, ["n", "pct"])


def population_of(dim: DataFrame, key: str | None = None, value: str | None = None) -> Column:
    """Total population (in thousands) of one region or of all, as a scalar subquery."""
    chosen = dim if key is None else dim.filter(F.col(key) == value)
    return chosen.agg(F.sum("population")).scalar()


def region_categories(df: DataFrame, dim: DataFrame, region: str, k: int = 10) -> DataFrame:
    """The region's top categories by rate, against the overall rate."""
    ratios = rate_ratio(
        df, matches(province=region), "fraud_cat", population_of(dim, "province", region), population_of(dim)
    )
    level = label_if([(F.col("rate_ratio") > 1, ABOVE)], BELOW)
    return top_k(ratios.withColumn("level", level), "slice_rate", k, "fraud_cat")


def region_contribution(df: DataFrame, region: str, k: int = 8) -> DataFrame:
    return top_k(contribution(df, matches(province=region), "fraud_cat"), "slice_n", k, "fraud_cat")


def region_ages(df: DataFrame, dim: DataFrame, region: str, min_count: int = 500) -> DataFrame:
    """Age groups of the region with their share of the overall group and their rate."""
    ages = contribution(df, matches(province=region), "age_range").withColumn(
        "slice_rate", rate_per("slice_n", population_of(dim, "province", region))
    )
    return rank_desc(not_like(ages, "age_range").filter(F.col("slice_n") > min_count), "slice_rate", "age_range")


def region_genders(df: DataFrame, region: str, min_count: int = 1000) -> DataFrame:
    return freq(slice_rows(df, province=region), "gender").filter(F.col("n") > min_count)


def region_age_categories(df: DataFrame, region: str, ages: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Percent of each age group per category, for chosen groups and categories."""
    cells = row_pct(cross_freq(slice_rows(df, province=region), "age_range", "fraud_cat"), "age_range")
    return keep_in(keep_in(cells, "age_range", ages), "fraud_cat", categories)
