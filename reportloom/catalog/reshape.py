"""Set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import decimals_to_double
from ..operators.aggregates import freq, monthly_summary
from ..operators.reshape import lengthen, stack, widen, widen_null
from ..sources.tables import complaints
from .registry import MONTHLY, over, query

CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "u01_stack",
    over(
        """SELECT 'gender' AS kind, gender AS level, count(*) AS n FROM complaints_v WHERE gender IS NOT NULL GROUP BY gender
           UNION ALL SELECT 'sol_method', sol_method, count(*) FROM complaints_v WHERE sol_method IS NOT NULL GROUP BY sol_method"""
    ),
)
def u01(spark, sf_dir):
    rows = complaints(spark, sf_dir, "gender", "sol_method")
    return stack(
        *[freq(rows, key).select(F.lit(key).alias("kind"), F.col(key).alias("level"), "n") for key in ("gender", "sol_method")]
    )


@query(
    "u02_widen",
    over(
        """SELECT CAST(date_trunc('month', date) AS DATE) AS month_date,
                  CAST(coalesce(sum(num_victims) FILTER (fraud_cat = '1-URGENT'), 0) AS BIGINT) AS urgent,
                  CAST(coalesce(sum(num_victims) FILTER (fraud_cat = '5-LOW'), 0) AS BIGINT) AS low
           FROM complaints_v GROUP BY ALL"""
    ),
)
def u02(spark, sf_dir):
    rows = complaints(spark, sf_dir, "date", "fraud_cat", "num_victims")
    rows = rows.withColumn("month_date", F.trunc("date", "month"))
    wide = widen(rows, "month_date", "fraud_cat", "num_victims", CATEGORIES)
    return wide.select("month_date", F.col("`1-URGENT`").alias("urgent"), F.col("`5-LOW`").alias("low"))


@query(
    "u03_widen_null",
    over(
        """SELECT province, CAST(sum(dollar_loss) FILTER (year(date) = 1995) AS DOUBLE) AS loss_1995,
                  CAST(sum(dollar_loss) FILTER (year(date) = 1996) AS DOUBLE) AS loss_1996,
                  CAST(sum(dollar_loss) FILTER (year(date) = 2002) AS DOUBLE) AS loss_2002 FROM complaints_v GROUP BY 1"""
    ),
)
def u03(spark, sf_dir):
    rows = complaints(spark, sf_dir, "date", "province", "dollar_loss").withColumn("year", F.year("date"))
    return decimals_to_double(widen_null(rows, "province", "year", "dollar_loss", [1995, 1996, 2002], prefix="loss_"))


@query(
    "u04_lengthen",
    over(
        """SELECT year, month, 'total_loss' AS name, CAST(total_loss AS DOUBLE) AS value FROM monthly_v
           UNION ALL SELECT year, month, 'total_victims', CAST(total_victims AS DOUBLE) FROM monthly_v""",
        MONTHLY,
    ),
)
def u04(spark, sf_dir):
    monthly = monthly_summary(complaints(spark, sf_dir, "date", "dollar_loss", "num_victims"))
    doubles = monthly.withColumns({c: F.col(c).cast("double") for c in ("total_loss", "total_victims")})
    return lengthen(doubles, ["year", "month"], ["total_loss", "total_victims"])
