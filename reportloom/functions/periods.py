"""Calendar keys and labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .parsing import column


def period_keys(df: DataFrame, day: str) -> DataFrame:
    """Add `year`, `month` and `year_month` (`YYYY-MM`)."""
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "year_month": F.date_format(day, "yyyy-MM"),
        }
    )


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(column(year), column(month), F.lit(1))


def quarter_label(day: Column | str) -> Column:
    """`2025_Q3`."""
    return F.date_format(column(day), "yyyy'_Q'q")


def month_name(day: Column | str, with_year: bool = False) -> Column:
    return F.date_format(column(day), "MMMM yyyy" if with_year else "MMMM")


def quarter_bounds(year: int, quarter: int) -> tuple[dt.date, dt.date]:
    """First day of the quarter and first day of the next one."""
    start = dt.date(year, 3 * quarter - 2, 1)
    end = dt.date(year + quarter // 4, 3 * quarter % 12 + 1, 1)
    return start, end
