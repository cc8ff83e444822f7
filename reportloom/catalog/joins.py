"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import cross_freq, freq, sum_by
from ..operators.filters import positive, slice_rows
from ..operators.joins import complete, inner_on, left_dim, lookup, semi_topk
from ..sources.tables import complaints, population, table
from .filters import COHORT
from .registry import POPULATION, over, query


@query(
    "j01_left_dim",
    over(
        """SELECT province, n, population FROM (SELECT province, count(*) AS n FROM complaints_v
           WHERE province IS NOT NULL GROUP BY 1) LEFT JOIN population_v USING (province)""",
        POPULATION,
    ),
)
def j01(spark, sf_dir):
    return left_dim(freq(complaints(spark, sf_dir, "province"), "province"), population(spark, sf_dir), "province")


@query(
    "j02_inner_on",
    over(
        """SELECT * FROM (SELECT sol_method, count(*) AS cohort_n FROM complaints_v WHERE age_range = '''10 - 19' GROUP BY 1)
           JOIN (SELECT sol_method, count(*) AS all_n FROM complaints_v GROUP BY 1) USING (sol_method)"""
    ),
)
def j02(spark, sf_dir):
    rows = complaints(spark, sf_dir, "sol_method", "age_range")
    cohort = freq(slice_rows(rows, age_range=COHORT), "sol_method", "cohort_n")
    return inner_on(cohort, freq(rows, "sol_method", "all_n"), "sol_method")


@query(
    "j03_lookup",
    """SELECT s_suppkey, s_nationkey, n_name AS nation FROM supplier LEFT JOIN (SELECT n_nationkey, n_name FROM nation
       JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA') ON s_nationkey = n_nationkey""",
)
def j03(spark, sf_dir):
    region = table(spark, sf_dir, "region").filter("r_name = 'ASIA'")
    nation = table(spark, sf_dir, "nation")
    asia = nation.join(region, nation.n_regionkey == region.r_regionkey, "left_semi")
    names = asia.withColumnRenamed("n_nationkey", "s_nationkey")
    return lookup(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), names, "s_nationkey", "n_name", "nation")


@query(
    "j04_semi_topk",
    over(
        """SELECT id, province FROM complaints_v WHERE province IN (SELECT province FROM complaints_v GROUP BY 1
           ORDER BY sum(dollar_loss) DESC NULLS LAST, province LIMIT 8)"""
    ),
)
def j04(spark, sf_dir):
    rows = complaints(spark, sf_dir, "id", "province", "dollar_loss")
    return semi_topk(rows, "province", sum_by(rows, "province", "dollar_loss"), "total", 8).select("id", "province")


@query(
    "j05_complete",
    over(
        """SELECT year_month, province, count(id) AS n FROM (SELECT DISTINCT year_month FROM big) CROSS JOIN
           (SELECT DISTINCT province FROM big) LEFT JOIN big USING (year_month, province) GROUP BY 1, 2""",
        """big AS (SELECT id, strftime(date, '%Y-%m') AS year_month, province FROM complaints_v
           WHERE dollar_loss > 0 AND age_range = '''10 - 19' AND province IS NOT NULL)""",
    ),
)
def j05(spark, sf_dir):
    rows = complaints(spark, sf_dir, "date", "province", "age_range", "dollar_loss")
    rows = positive(slice_rows(rows, age_range=COHORT), "dollar_loss")
    rows = rows.withColumn("year_month", F.date_format("date", "yyyy-MM"))
    return complete(cross_freq(rows, "year_month", "province"), "year_month", "province")
