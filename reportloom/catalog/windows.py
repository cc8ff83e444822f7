"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import decimals_to_double
from ..operators.aggregates import cross_freq, freq, monthly_summary, with_month, yearly_summary
from ..operators.filters import slice_rows
from ..operators.windows import fill_months, loess, pct_total, peak, peak_divergence, rolling_mean, row_pct, yoy
from ..plans.bulletin import monthly_trend
from ..sources.tables import complaints
from .filters import COHORT, REGION
from .registry import MONTHLY, over, query

KEYS = ("date", "dollar_loss", "num_victims")


@query(
    "w01_rolling_mean",
    over(
        """SELECT year, month, month_date, CAST(total_loss AS DOUBLE) AS total_loss, total_victims,
                  CAST(sum(total_loss) OVER f AS DOUBLE) / count(total_loss) OVER f AS loss_3mo_avg,
                  CAST(sum(total_victims) OVER f AS DOUBLE) / count(total_victims) OVER f AS victims_3mo_avg
           FROM monthly_v WINDOW f AS (ORDER BY month_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        MONTHLY,
    ),
)
def w01(spark, sf_dir):
    return decimals_to_double(monthly_trend(complaints(spark, sf_dir, *KEYS)))


@query(
    "w01_rolling_mean_by_series",
    over(
        """SELECT fraud_cat, month_date, CAST(total_loss AS DOUBLE) AS total_loss, total_victims,
                  CAST(sum(total_loss) OVER f AS DOUBLE) / count(total_loss) OVER f AS loss_3mo_avg
           FROM (SELECT fraud_cat, CAST(date_trunc('month', date) AS DATE) AS month_date, sum(dollar_loss) AS total_loss,
                        CAST(sum(num_victims) AS BIGINT) AS total_victims FROM complaints_v GROUP BY ALL)
           WINDOW f AS (PARTITION BY fraud_cat ORDER BY month_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
    ),
)
def w01_series(spark, sf_dir):
    monthly = with_month(monthly_summary(complaints(spark, sf_dir, *KEYS, "fraud_cat"), "date", "fraud_cat"))
    rolled = rolling_mean(monthly, "month_date", {"total_loss": "loss_3mo_avg"}, by=["fraud_cat"])
    return decimals_to_double(rolled.drop("year", "month"))


@query(
    "w01_rolling_mean_calendar",
    over(
        """SELECT month_date, total_victims, CAST(sum(total_victims) OVER f AS DOUBLE) / count(total_victims) OVER f AS victims_3mo_avg
           FROM (SELECT month_date, coalesce(v, 0) AS total_victims FROM months_v LEFT JOIN present_v USING (month_date))
           WINDOW f AS (ORDER BY month_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        """present_v AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month_date, CAST(sum(num_victims) AS BIGINT) AS v
             FROM complaints_v WHERE province = 'NATION_3' AND age_range = '''10 - 19' GROUP BY 1)""",
        """months_v AS (SELECT CAST(unnest(generate_series(min(month_date), max(month_date), INTERVAL 1 MONTH)) AS DATE) AS month_date
             FROM present_v)""",
    ),
)
def w01_calendar(spark, sf_dir):
    rows = slice_rows(complaints(spark, sf_dir, *KEYS, "province", "age_range"), province=REGION, age_range=COHORT)
    monthly = with_month(monthly_summary(rows)).select("month_date", "total_victims")
    filled = fill_months(monthly, "month_date", ["total_victims"])
    return rolling_mean(filled, "month_date", {"total_victims": "victims_3mo_avg"})


@query(
    "w02_yoy",
    over(
        """SELECT year, total_victims, total_victims - before AS yoy_change,
                  (CAST(total_victims AS DOUBLE) - CAST(before AS DOUBLE)) / nullif(CAST(before AS DOUBLE), 0) * 100 AS yoy_pct_change
           FROM (SELECT year, total_victims, lag(total_victims) OVER (ORDER BY year) AS before FROM (
                 SELECT year, CAST(sum(total_victims) AS BIGINT) AS total_victims FROM monthly_v GROUP BY 1))""",
        MONTHLY,
    ),
)
def w02(spark, sf_dir):
    yearly = yearly_summary(complaints(spark, sf_dir, *KEYS)).select("year", "total_victims")
    return yoy(yearly, "year", "total_victims")


@query(
    "w03_row_pct",
    over(
        """SELECT age_range, fraud_cat, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY age_range) AS DOUBLE) * 100 AS pct
           FROM (SELECT age_range, fraud_cat, count(*) AS n FROM complaints_v
                 WHERE age_range IS NOT NULL AND fraud_cat IS NOT NULL GROUP BY 1, 2)"""
    ),
)
def w03(spark, sf_dir):
    return row_pct(cross_freq(complaints(spark, sf_dir, "age_range", "fraud_cat"), "age_range", "fraud_cat"), "age_range")


@query(
    "w04_pct_total",
    over(
        """SELECT sol_method, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) * 100 AS pct
           FROM (SELECT sol_method, count(*) AS n FROM complaints_v WHERE sol_method IS NOT NULL GROUP BY 1)"""
    ),
)
def w04(spark, sf_dir):
    return pct_total(freq(complaints(spark, sf_dir, "sol_method"), "sol_method"))


@query(
    "w05_peak",
    over(
        """SELECT month_date, CAST(total_loss AS DOUBLE) AS total_loss, total_victims FROM monthly_v
           ORDER BY total_loss DESC NULLS LAST, month_date LIMIT 1""",
        MONTHLY,
    ),
)
def w05(spark, sf_dir):
    monthly = with_month(monthly_summary(complaints(spark, sf_dir, *KEYS)))
    return decimals_to_double(peak(monthly, "total_loss", "month_date").drop("year", "month"))


@query(
    "w05_peak_by_series",
    over(
        """SELECT province, year, total_victims FROM (SELECT *, row_number() OVER (PARTITION BY province
             ORDER BY total_victims DESC NULLS LAST, year) AS r FROM (SELECT province, CAST(year(date) AS INTEGER) AS year,
             CAST(sum(num_victims) AS BIGINT) AS total_victims FROM complaints_v GROUP BY ALL)) WHERE r = 1"""
    ),
)
def w05_series(spark, sf_dir):
    yearly = (
        complaints(spark, sf_dir, "date", "province", "num_victims")
        .groupBy("province", F.year("date").alias("year"))
        .agg(F.sum("num_victims").alias("total_victims"))
    )
    return peak(yearly, "total_victims", "year", by=["province"])


@query(
    "w06_peak_divergence",
    over(
        """SELECT CAST(l.total_loss AS DOUBLE) AS peak_total_loss, l.month_date AS peak_total_loss_date,
                  v.total_victims AS peak_total_victims, v.month_date AS peak_total_victims_date,
                  CASE WHEN l.month_date = v.month_date THEN 'parallel spike' ELSE 'strong divergence' END AS divergence
           FROM (SELECT * FROM monthly_v ORDER BY total_loss DESC NULLS LAST, month_date LIMIT 1) l,
                (SELECT * FROM monthly_v ORDER BY total_victims DESC NULLS LAST, month_date LIMIT 1) v""",
        MONTHLY,
    ),
)
def w06(spark, sf_dir):
    monthly = with_month(monthly_summary(complaints(spark, sf_dir, *KEYS)))
    return decimals_to_double(peak_divergence(monthly, "total_loss", "total_victims", "month_date"))


@query(
    "w07_loess",
    over(
        """SELECT fraud_cat, day_no, total_victims,
                  round((t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2))
                        / (s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2)), 4) AS trend
           FROM (SELECT fraud_cat, here AS day_no, any_value(own) AS total_victims, sum(w) AS s0, sum(w * d) AS s1,
                        sum(w * d * d) AS s2, sum(w * d * d * d) AS s3, sum(w * d * d * d * d) AS s4,
                        sum(w * y) AS t0, sum(w * d * y) AS t1, sum(w * d * d * y) AS t2
                 FROM (SELECT *, CASE WHEN gap < reach THEN pow(1 - pow(gap / reach, 3), 3) ELSE 0 END AS w FROM near_v)
                 GROUP BY 1, 2)""",
        """points_v AS (SELECT fraud_cat, CAST(m - DATE '1970-01-01' AS INTEGER) AS x, CAST(sum(num_victims) AS DOUBLE) AS y
             FROM (SELECT *, CAST(date_trunc('month', date) AS DATE) AS m FROM complaints_v) GROUP BY 1, 2)""",
        """pairs_v AS (SELECT a.fraud_cat, a.x AS here, a.y AS own, b.y, (b.x - a.x) / 1000.0::DOUBLE AS d,
             abs(b.x - a.x) / 1000.0::DOUBLE AS gap, row_number() OVER (PARTITION BY a.fraud_cat, a.x ORDER BY abs(b.x - a.x)) AS place,
             CAST(floor(0.75 * count(*) OVER (PARTITION BY a.fraud_cat, a.x) + 0.00001) AS BIGINT) AS k
             FROM points_v a JOIN points_v b ON a.fraud_cat = b.fraud_cat)""",
        """near_v AS (SELECT *, max(CASE WHEN place = k THEN gap END) OVER (PARTITION BY fraud_cat, here) AS reach FROM pairs_v)""",
    ),
)
def w07(spark, sf_dir):
    monthly = with_month(monthly_summary(complaints(spark, sf_dir, *KEYS, "fraud_cat"), "date", "fraud_cat"))
    points = monthly.select("fraud_cat", F.unix_date("month_date").alias("day_no"), F.col("total_victims").cast("double"))
    smooth = loess(points, "day_no", "total_victims", by="fraud_cat")
    return smooth.withColumn("trend", F.round("trend", 4))
