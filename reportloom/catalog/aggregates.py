"""Aggregations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.numbers import decimals_to_double
from ..operators.aggregates import (
    bracket_tail,
    compare_stats,
    contribution,
    cross_freq,
    date_bounds,
    freq,
    loss_profile,
    margins,
    mean_count,
    monthly_by_cat,
    monthly_counts,
    monthly_summary,
    per_capita,
    period_change,
    pooled_rate,
    positive_brackets,
    rate_ratio,
    rate_trend,
    seasonality,
    share_of_parent,
    slice_stats,
    sum_by,
    tag_counts,
    yearly_summary,
)
from ..operators.filters import matches, positive, slice_rows
from ..operators.joins import complete
from ..operators.ranking import rank_desc
from ..operators.search import group_hits
from ..plans.regional import population_of
from ..sources.tables import complaints, population, table
from .filters import COHORT, REGION
from .registry import MONTHLY, POPULATION, over, query

KEYS = ("date", "dollar_loss", "num_victims")
REGIONS = ["NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5"]
IN_REGIONS = "province IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5')"
LABELS_SQL = """labels_v AS (SELECT CAST(no AS INTEGER) AS bracket_no, bracket, lo, hi FROM (VALUES (1, '$1-100', 0, 100),
  (2, '$101-500', 100, 500), (3, '$501-1000', 500, 1000), (4, '$1001-5000', 1000, 5000),
  (5, '$5001-10000', 5000, 10000), (6, '>$10000', 10000, 1000000000)) v(no, bracket, lo, hi)),
dist_v AS (SELECT bracket_no, bracket, count(id) AS n FROM labels_v LEFT JOIN complaints_v
  ON dollar_loss > lo AND dollar_loss <= hi GROUP BY 1, 2)"""


@query("a01_date_bounds", over("SELECT min(date) AS min_date, max(date) AS max_date FROM complaints_v"))
def a01(spark, sf_dir):
    return date_bounds(complaints(spark, sf_dir, "date"))


@query(
    "a02_monthly_summary",
    over("SELECT year, month, CAST(total_loss AS DOUBLE) AS total_loss, total_victims FROM monthly_v", MONTHLY),
)
def a02(spark, sf_dir):
    return decimals_to_double(monthly_summary(complaints(spark, sf_dir, *KEYS)))


@query(
    "a03_yearly_summary",
    over(
        """SELECT year, CAST(sum(total_loss) AS DOUBLE) AS total_loss, CAST(sum(total_victims) AS BIGINT) AS total_victims
           FROM monthly_v GROUP BY 1""",
        MONTHLY,
    ),
)
def a03(spark, sf_dir):
    return decimals_to_double(yearly_summary(complaints(spark, sf_dir, *KEYS)))


@query("a04_sum_by", over("SELECT fraud_cat, CAST(sum(dollar_loss) AS DOUBLE) AS total FROM complaints_v GROUP BY 1"))
def a04(spark, sf_dir):
    return decimals_to_double(sum_by(complaints(spark, sf_dir, "fraud_cat", "dollar_loss"), "fraud_cat", "dollar_loss"))


@query(
    "a05_monthly_by_cat",
    over(
        """SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, fraud_cat,
                  CAST(sum(dollar_loss) AS DOUBLE) AS total_loss FROM complaints_v GROUP BY ALL"""
    ),
)
def a05(spark, sf_dir):
    return decimals_to_double(monthly_by_cat(complaints(spark, sf_dir, "date", "fraud_cat", "dollar_loss")))


@query("a06_freq", over("SELECT age_range, count(*) AS n FROM complaints_v WHERE age_range IS NOT NULL GROUP BY 1"))
def a06(spark, sf_dir):
    return freq(complaints(spark, sf_dir, "age_range"), "age_range")


@query(
    "a07_cross_freq",
    over(
        """SELECT province, fraud_cat, count(id) AS n FROM (SELECT DISTINCT province FROM complaints_v WHERE province IS NOT NULL)
           CROSS JOIN (SELECT DISTINCT fraud_cat FROM complaints_v WHERE fraud_cat IS NOT NULL)
           LEFT JOIN complaints_v USING (province, fraud_cat) GROUP BY 1, 2"""
    ),
)
def a07(spark, sf_dir):
    cells = cross_freq(complaints(spark, sf_dir, "province", "fraud_cat"), "province", "fraud_cat")
    return complete(cells, "province", "fraud_cat")


@query(
    "a08_mean_count",
    over(
        """SELECT sol_method, CAST(sum(dollar_loss) AS DOUBLE) / count(*) AS avg_loss, count(*) AS n
           FROM complaints_v WHERE sol_method IS NOT NULL AND dollar_loss IS NOT NULL GROUP BY 1"""
    ),
)
def a08(spark, sf_dir):
    return mean_count(complaints(spark, sf_dir, "sol_method", "dollar_loss"), "sol_method", "dollar_loss")


PROFILE = """CAST(sum(dollar_loss) AS DOUBLE) / count(*) AS avg_loss, median(CAST(dollar_loss AS DOUBLE)) AS median_loss,
             CAST(sum(dollar_loss) AS DOUBLE) AS total_loss, count(*) AS n"""


@query(
    "a09_loss_profile",
    over(f"SELECT age_range, {PROFILE} FROM complaints_v WHERE dollar_loss > 0 AND age_range IS NOT NULL GROUP BY 1"),
)
def a09(spark, sf_dir):
    rows = positive(complaints(spark, sf_dir, "age_range", "dollar_loss"), "dollar_loss")
    return decimals_to_double(loss_profile(rows, "age_range"))


@query(
    "a09_loss_profile_double",
    "SELECT l_returnflag, median(l_extendedprice) AS median_loss, count(*) AS n FROM lineitem GROUP BY 1",
)
def a09_double(spark, sf_dir):
    """A measure in double precision, whose values hardly repeat."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return loss_profile(rows, "l_returnflag", "l_extendedprice").select("l_returnflag", "median_loss", "n")


@query("a10_slice_stats_double", "SELECT median(l_extendedprice) AS median_loss, count(*) AS n FROM lineitem WHERE l_quantity < 10")
def a10_double(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").filter("l_quantity < 10")
    return slice_stats(rows, "l_extendedprice").select("median_loss", "n")


@query(
    "a11_compare_stats_double",
    """SELECT 'all' AS scope, median(l_extendedprice) AS median_loss, count(*) AS n FROM lineitem
       UNION ALL SELECT 'slice', median(l_extendedprice), count(*) FROM lineitem WHERE l_returnflag = 'R'""",
)
def a11_double(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return compare_stats(rows, F.col("l_returnflag") == "R", "l_extendedprice").select("scope", "median_loss", "n")


@query(
    "a10_slice_stats",
    over(f"SELECT {PROFILE} FROM complaints_v WHERE province = 'NATION_3' AND dollar_loss > 0"),
)
def a10(spark, sf_dir):
    rows = slice_rows(complaints(spark, sf_dir, "province", "dollar_loss"), province=REGION)
    return decimals_to_double(slice_stats(positive(rows, "dollar_loss")))


@query(
    "a11_compare_stats",
    over(
        f"""SELECT 'slice' AS scope, {PROFILE} FROM complaints_v WHERE province = 'NATION_3' AND dollar_loss > 0
            UNION ALL SELECT 'all', {PROFILE} FROM complaints_v WHERE dollar_loss > 0"""
    ),
)
def a11(spark, sf_dir):
    rows = positive(complaints(spark, sf_dir, "province", "dollar_loss"), "dollar_loss")
    return decimals_to_double(compare_stats(rows, matches(province=REGION)))


@query(
    "a12_share_of_parent",
    over(
        """SELECT count(*) FILTER (age_range = '''10 - 19') AS n, count(*) AS parent_n,
                  CAST(count(*) FILTER (age_range = '''10 - 19') AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS pct
           FROM complaints_v WHERE province = 'NATION_3'"""
    ),
)
def a12(spark, sf_dir):
    region = slice_rows(complaints(spark, sf_dir, "province", "age_range"), province=REGION)
    return share_of_parent(region, matches(age_range=COHORT))


COUNTS_SQL = """counts_v AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n
  FROM complaints_v WHERE date IS NOT NULL GROUP BY ALL)"""


@query("a13_monthly_counts", over("SELECT year, month, n FROM counts_v", COUNTS_SQL))
def a13(spark, sf_dir):
    return monthly_counts(complaints(spark, sf_dir, "date"))


@query(
    "a14_seasonality",
    over(
        """SELECT month, CAST(sum(n) AS DOUBLE) / count(*) AS avg_monthly, CAST(sum(n) AS BIGINT) AS total_monthly
           FROM counts_v GROUP BY 1""",
        COUNTS_SQL,
    ),
)
def a14(spark, sf_dir):
    return seasonality(complaints(spark, sf_dir, "date"))


@query(
    "a15_margins",
    over(
        """SELECT 'province' AS axis, province AS key, count(*) AS n FROM complaints_v
           WHERE province IS NOT NULL AND fraud_cat IS NOT NULL GROUP BY province
           UNION ALL SELECT 'fraud_cat', fraud_cat, count(*) FROM complaints_v
           WHERE province IS NOT NULL AND fraud_cat IS NOT NULL GROUP BY fraud_cat"""
    ),
)
def a15(spark, sf_dir):
    return margins(complaints(spark, sf_dir, "province", "fraud_cat"), "province", "fraud_cat")


@query(
    "a16_bracket_dist",
    over(
        """SELECT bracket_no, bracket, n, CAST(n AS DOUBLE) / nullif((SELECT CAST(sum(n) AS DOUBLE) FROM dist_v), 0) * 100 AS pct
           FROM dist_v""",
        LABELS_SQL,
    ),
)
def a16(spark, sf_dir):
    return positive_brackets(complaints(spark, sf_dir, "dollar_loss"))


@query(
    "a17_bracket_tail",
    over(
        """SELECT CAST(sum(n) FILTER (bracket_no >= 5) AS BIGINT) AS high_n, CAST(sum(n) FILTER (bracket_no <= 2) AS BIGINT) AS low_n,
                  CAST(sum(n) FILTER (bracket_no >= 5) AS DOUBLE) / nullif(CAST(sum(n) AS DOUBLE), 0) * 100 AS high_pct,
                  CAST(sum(n) FILTER (bracket_no <= 2) AS DOUBLE) / nullif(CAST(sum(n) AS DOUBLE), 0) * 100 AS low_pct FROM dist_v""",
        LABELS_SQL,
    ),
)
def a17(spark, sf_dir):
    tails = {"high": ["$5001-10000", ">$10000"], "low": ["$1-100", "$101-500"]}
    return bracket_tail(positive_brackets(complaints(spark, sf_dir, "dollar_loss")), tails)


@query(
    "a18_pooled_rate",
    over(
        f"""SELECT CAST(sum(n) AS BIGINT) AS n, sum(population) AS population,
                   CAST(sum(n) AS DOUBLE) / (sum(population) * 1000) * 100000 AS rate_per_100k
            FROM (SELECT province, count(*) AS n FROM complaints_v WHERE {IN_REGIONS} GROUP BY 1) JOIN population_v USING (province)""",
        POPULATION,
    ),
)
def a18(spark, sf_dir):
    return pooled_rate(complaints(spark, sf_dir, "province"), population(spark, sf_dir), "province", REGIONS)


@query(
    "a19_rate_ratio",
    over(
        """SELECT *, slice_rate / all_rate AS rate_ratio FROM (SELECT fraud_cat, slice_n, all_n,
             CAST(slice_n AS DOUBLE) / ((SELECT sum(population) FROM population_v WHERE province = 'NATION_3') * 1000) * 100000 AS slice_rate,
             CAST(all_n AS DOUBLE) / ((SELECT sum(population) FROM population_v) * 1000) * 100000 AS all_rate
           FROM (SELECT fraud_cat, count(*) FILTER (province = 'NATION_3') AS slice_n, count(*) AS all_n FROM complaints_v
                 WHERE fraud_cat IS NOT NULL GROUP BY 1) WHERE slice_n > 0)""",
        POPULATION,
    ),
)
def a19(spark, sf_dir):
    dim = population(spark, sf_dir)
    return rate_ratio(
        complaints(spark, sf_dir, "province", "fraud_cat"),
        matches(province=REGION),
        "fraud_cat",
        population_of(dim, "province", REGION),
        population_of(dim),
    )


@query(
    "a20_contribution",
    over(
        """SELECT sol_method, slice_n, all_n, CAST(slice_n AS DOUBLE) / CAST(all_n AS DOUBLE) * 100 AS share_pct
           FROM (SELECT sol_method, count(*) FILTER (province = 'NATION_3') AS slice_n, count(*) AS all_n FROM complaints_v
                 WHERE sol_method IS NOT NULL GROUP BY 1) WHERE slice_n > 0"""
    ),
)
def a20(spark, sf_dir):
    return contribution(complaints(spark, sf_dir, "province", "sol_method"), matches(province=REGION), "sol_method")


@query(
    "a21_period_change",
    over(
        """SELECT fraud_cat, n_before, n_after, (CAST(n_after AS DOUBLE) - CAST(n_before AS DOUBLE)) / CAST(n_before AS DOUBLE) * 100 AS change_pct
           FROM (SELECT fraud_cat, count(*) FILTER (year(date) = 1996) AS n_before, count(*) FILTER (year(date) = 1997) AS n_after
                 FROM complaints_v WHERE fraud_cat IS NOT NULL GROUP BY 1) WHERE n_before > 0"""
    ),
)
def a21(spark, sf_dir):
    two_years = (dt.date(1996, 1, 1), dt.date(1998, 1, 1))
    rows = complaints(spark, sf_dir, "date", "fraud_cat", period=two_years)
    return period_change(rows, "fraud_cat", F.year("date"), 1996, 1997)


@query(
    "a22_rate_trend",
    over(
        f"""SELECT *, CAST(n AS DOUBLE) / (population * 1000) * 100000 AS rate_per_100k FROM (SELECT province,
            CAST(year(date) AS INTEGER) AS year, count(*) AS n FROM complaints_v WHERE {IN_REGIONS} GROUP BY ALL)
            LEFT JOIN population_v USING (province)""",
        POPULATION,
    ),
)
def a22(spark, sf_dir):
    return rate_trend(complaints(spark, sf_dir, "date", "province"), population(spark, sf_dir), "province", REGIONS)


@query(
    "a23_per_capita",
    over(
        """SELECT *, CAST(n AS DOUBLE) / (population * 1000) * 100000 AS rate_per_100k FROM (SELECT province, count(*) AS n
           FROM complaints_v WHERE province IS NOT NULL GROUP BY 1 HAVING count(*) > 500) JOIN population_v USING (province)""",
        POPULATION,
    ),
)
def a23(spark, sf_dir):
    ranked = per_capita(complaints(spark, sf_dir, "province"), population(spark, sf_dir), "province", 500)
    return rank_desc(ranked, "rate_per_100k", "province")


@query("a24_tag_counts", "SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY 1")
def a24(spark, sf_dir):
    return tag_counts(table(spark, sf_dir, "part"), "p_name", " ")


@query("a24_tag_counts_pipe", "SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY 1")
def a24_pipe(spark, sf_dir):
    """A separator that means something in a regular expression."""
    piped = table(spark, sf_dir, "part").select(F.replace("p_name", F.lit(" "), F.lit("|")).alias("tags"))
    return tag_counts(piped, "tags", "|")


@query(
    "a25_group_hits",
    """WITH hits AS (SELECT doc_id, '/' || source || CASE WHEN n_chars < 400 THEN '' ELSE '#' || doc_id END AS href
                     FROM documents WHERE contains(lower(text), 'tion')),
            placed AS (SELECT *, split_part(href, '#', 1) AS document, instr(href, '#') = 0 AS is_document FROM hits),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY document ORDER BY is_document DESC, CASE WHEN is_document THEN -doc_id ELSE doc_id END) AS position,
                              count(*) OVER (PARTITION BY document) AS hits FROM placed)
       SELECT document, doc_id, href, is_document, CAST(position AS INTEGER) AS position, hits,
              CASE WHEN position = 1 THEN 'document' ELSE 'item' END AS row_type, greatest(hits - 3, 0) AS remaining
       FROM ranked WHERE position <= 3""",
)
def a25(spark, sf_dir):
    found = table(spark, sf_dir, "documents").filter(F.lower("text").contains("tion"))
    anchor = F.when(F.col("n_chars") < 400, "").otherwise(F.concat(F.lit("#"), F.col("doc_id").cast("string")))
    hits = found.select("doc_id", F.concat(F.lit("/"), "source", anchor).alias("href"))
    return group_hits(hits, "href", "doc_id")
