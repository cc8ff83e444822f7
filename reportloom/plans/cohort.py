"""Cohort reports: one age group in one region, against the whole and over time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import label_if
from ..functions.periods import month_name
from ..operators.aggregates import (
    bracket_dist,
    compare_stats,
    contribution,
    freq,
    loss_profile,
    period_change,
    rate_trend,
    seasonality,
)
from ..operators.filters import between_days, matches, not_like, positive, slice_rows
from ..operators.ranking import rank_desc
from ..operators.reshape import widen_null
from ..operators.windows import pct_total, yoy

# Names of declines below a percent change, steepest first, and of the rest.
DECLINES = ((-70, "Major Decline (>70%)"), (-50, "Large Decline (50-70%)"))
OTHER_DECLINE = "Moderate Decline (<50%)"


def cohort_breakdown(cohort: DataFrame, key: str, min_count: int = 50) -> DataFrame:
    """Count and percent per level; percentages are over all levels, small ones are dropped after."""
    return rank_desc(pct_total(freq(cohort, key)).filter(F.col("n") > min_count), "n", key)


def cohort_share(cohort: DataFrame, region: str, key: str = "sol_method", min_count: int = 50) -> DataFrame:
    """The region's share of the cohort's overall reports, per level."""
    shares = contribution(cohort, matches(province=region), key).filter(F.col("slice_n") > min_count)
    return rank_desc(shares, "share_pct", key)


def cohort_losses(df: DataFrame, region: str, cohort: str, min_count: int = 100) -> DataFrame:
    """Loss profile of every age group of the region, the cohort marked."""
    rows = not_like(positive(slice_rows(df, province=region), "dollar_loss"), "age_range")
    profile = loss_profile(rows, "age_range").filter(F.col("n") > min_count)
    group = label_if([(F.col("age_range") == cohort, "Cohort")], "Other Ages")
    return rank_desc(profile.withColumn("age_group", group), "avg_loss", "age_range")


def cohort_loss_comparison(cohort: DataFrame, region: str) -> DataFrame:
    return compare_stats(positive(cohort, "dollar_loss"), matches(province=region))


def cohort_brackets(cohort: DataFrame, region: str) -> DataFrame:
    return bracket_dist(positive(slice_rows(cohort, province=region), "dollar_loss"))


def cohort_years(cohort: DataFrame, day: str = "date") -> DataFrame:
    """Yearly counts with their change against the year before."""
    return yoy(freq(cohort.withColumn("year", F.year(day)), "year"), "year", "n")


def cohort_seasons(cohort: DataFrame, min_total: int = 200) -> DataFrame:
    months = seasonality(cohort).filter(F.col("total_monthly") > min_total)
    return months.withColumn("month_name", month_name(F.make_date(F.lit(2000), "month", F.lit(1))))


def cohort_share_by_year(cohort: DataFrame, region: str, day: str = "date") -> DataFrame:
    return contribution(cohort.withColumn("year", F.year(day)), matches(province=region), "year")


def cohort_rates_wide(cohort: DataFrame, dim: DataFrame, regions: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Yearly rate per region, one column per year; a missing year stays null."""
    rates = rate_trend(cohort, dim, "province", regions)
    return widen_null(rates, "province", "year", "rate_per_100k", years, prefix="rate_")


def cohort_decline(cohort: DataFrame, key: str, before: int, after: int, day: str = "date") -> DataFrame:
    """Change per level between two years, steepest decline first; only their date range is read."""
    first, last = dt.date(min(before, after), 1, 1), dt.date(max(before, after) + 1, 1, 1)
    change = period_change(between_days(cohort, day, first, last), key, F.year(day), before, after)
    severity = label_if([(F.col("change_pct") < bound, name) for bound, name in DECLINES], OTHER_DECLINE)
    return rank_desc(change.withColumn("severity", severity), "change_pct", key, ascending=True)
