"""Quarterly bulletin: trend, peaks, narrative, and the top categories of the latest quarter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import fmt_count, fmt_money
from ..functions.periods import month_name, quarter_bounds, quarter_label
from ..operators.aggregates import monthly_by_cat, monthly_summary, sum_by, with_month
from ..operators.filters import dropna_keys
from ..operators.ranking import top_k
from ..operators.reshape import widen
from ..operators.windows import peak_divergence, rolling_mean


def monthly_trend(df: DataFrame) -> DataFrame:
    """Monthly totals with their trailing three-row means."""
    return rolling_mean(
        with_month(monthly_summary(df)),
        "month_date",
        {"total_loss": "loss_3mo_avg", "total_victims": "victims_3mo_avg"},
    )


def latest_quarter(df: DataFrame, day: str = "date") -> tuple[dt.date, dt.date]:
    """Bounds of the quarter of the newest row, or an empty range without dated rows; collects one date."""
    newest = df.agg(F.max(day)).first()[0]
    if newest is None:
        return dt.date(1970, 1, 1), dt.date(1970, 1, 1)
    return quarter_bounds(newest.year, (newest.month - 1) // 3 + 1)


# Wording of the bulletin.
NARRATIVE = (
    "In %s, the %s recorded its highest monthly financial loss in %s at %s. "
    "The month with the largest number of reported victims was %s, with %s individuals impacted. "
    "This quarter shows %s, highlighting potential changes in fraud targeting patterns."
)


def narrative(publisher: str) -> Column:
    facts = [F.col(c) for c in ("loss_month", "peak_loss", "victims_month", "peak_victims")]
    text = F.format_string(NARRATIVE, F.col("label"), F.lit(publisher), *facts, F.concat(F.lit("a "), "divergence"))
    return F.when(F.col("divergence").isNotNull(), text)


def bulletin_facts(df: DataFrame, publisher: str = "reporting centre") -> DataFrame:
    """One row of key facts, from one pass over the reports.

    The date bounds ride along with the monthly totals, so everything else reads monthly rows.
    """
    monthly = df.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.sum("dollar_loss").alias("total_loss"),
        F.sum("num_victims").alias("total_victims"),
        F.min("date").alias("lo"),
        F.max("date").alias("hi"),
    )
    dated = with_month(monthly)
    return (
        peak_divergence(dated, "total_loss", "total_victims", "month_date", F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select(
            quarter_label("hi").alias("label"),
            F.col("lo").alias("min_date"),
            F.col("hi").alias("max_date"),
            fmt_money("peak_total_loss").alias("peak_loss"),
            month_name("peak_total_loss_date", True).alias("loss_month"),
            fmt_count("peak_total_victims").alias("peak_victims"),
            month_name("peak_total_victims_date", True).alias("victims_month"),
            "divergence",
        )
        .withColumn("narrative", narrative(publisher))
    )


def top_categories(quarter: DataFrame, key: str = "fraud_cat", measure: str = "dollar_loss", k: int = 3) -> DataFrame:
    """Largest categories of a quarter; a null category may take a place and is then dropped."""
    return dropna_keys(top_k(sum_by(quarter, key, measure, "loss_total"), "loss_total", k, key), key)


def category_trend(quarter: DataFrame, key: str = "fraud_cat", measure: str = "dollar_loss", k: int = 3) -> DataFrame:
    """Monthly loss of the top categories, long form.

    Categories are ranked on their monthly cells, so the quarter is read once. The ranking keeps
    only the cells of k categories per task before they meet.
    """
    totals = F.sum("total_loss").over(Window.partitionBy(key))
    place = F.dense_rank().over(Window.orderBy(F.col("_total").desc_nulls_last(), key))
    cells = monthly_by_cat(quarter, key, measure).withColumn("_total", totals)
    top = cells.withColumn("_place", place).filter(F.col("_place") <= k).drop("_total", "_place")
    return with_month(dropna_keys(top, key))


def category_matrix(quarter: DataFrame, key: str = "fraud_cat", measure: str = "dollar_loss", k: int = 3) -> DataFrame:
    """The same as a month x category matrix with zeros, columns in rank order (k labels are collected)."""
    names = [row[0] for row in top_categories(quarter, key, measure, k).collect()]
    kept = quarter.filter(F.col(key).isin(names))
    return widen(with_month(monthly_by_cat(kept, key, measure)), "month_date", key, "total_loss", names)
