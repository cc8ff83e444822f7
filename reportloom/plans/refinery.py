"""Raw report drop -> clean table and its monthly and yearly roll-ups, filed under the latest quarter."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.periods import quarter_label
from ..operators.aggregates import date_bounds, monthly_summary, yearly_from_monthly
from ..operators.cleaning import clean_reports
from ..sources.delimited import newest_drop, newest_file, read_delimited
from ..sources.outputs import write_output


@dataclass
class Refined:
    label: str
    clean: DataFrame
    monthly: DataFrame
    yearly: DataFrame


def refine(
    spark: SparkSession,
    drops: str,
    out: str,
    glob: str = "*.tsv",
    country_sentinel: str | None = "Not Specified",
    delivery: bool = False,
) -> Refined:
    """Refine the newest file below `drops`, or with `delivery` the newest folder of part files.

    The text is parsed once. The clean table is written to a staging folder of this run as Parquet; bounds,
    label, CSV copy and both summaries read that (and the yearly one reads the monthly one).
    """
    newest = newest_drop(spark, drops, glob) if delivery else newest_file(spark, drops, glob)
    raw = read_delimited(spark, newest, glob=glob)
    staging = f"{out}/staging/{uuid.uuid4().hex}"
    clean_reports(raw, country_sentinel).write.parquet(staging)
    clean = spark.read.parquet(staging)

    label = date_bounds(clean).select(quarter_label("max_date")).first()[0]
    if label is None:
        raise ValueError("no dated reports to refine")
    write_output(clean, out, label, "clean_reports")
    monthly = spark.read.parquet(write_output(monthly_summary(clean), out, label, "monthly", "parquet"))
    write_output(monthly.orderBy("year", "month"), out, label, "monthly_summary")
    yearly = yearly_from_monthly(monthly)
    write_output(yearly.orderBy("year"), out, label, "yearly_summary")
    return Refined(label, clean, monthly, yearly)


def with_label(df: DataFrame, day: str = "date") -> DataFrame:
    return df.withColumn("label", quarter_label(F.col(day)))
