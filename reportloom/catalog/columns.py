"""Projection and cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.links import add_param, base_url, is_document_url, link_html, suffix
from ..functions.numbers import (
    bracket_label,
    bracket_no,
    decimals_to_double,
    fmt_count,
    fmt_money,
    fmt_pct,
    fmt_times,
    label_if,
    rate_per,
    rounded,
    scale,
    share_pct,
)
from ..functions.parsing import to_day, to_int, to_money
from ..functions.periods import month_name, month_start, period_keys, quarter_label
from ..operators.aggregates import freq, monthly_summary, with_month, yearly_summary
from ..operators.cleaning import drop_cols, numeric_cols_except, rename_map, select_cols
from ..operators.windows import yoy
from ..plans.feed_digest import page_title
from ..sources.outputs import output_path
from ..sources.tables import complaints, population, table
from .registry import MONTHLY, POPULATION, over, query

KEYS = ("date", "dollar_loss", "num_victims")


@query("p01_drop_cols", over("SELECT id, date, fraud_cat FROM complaints_v"))
def p01(spark, sf_dir):
    return drop_cols(complaints(spark, sf_dir, "id", "date", "fraud_cat", "gender"), ["gender", "not there"])


@query("p02_rename_map", "SELECT o_orderkey AS id, o_custkey, o_orderpriority AS fraud_cat FROM orders")
def p02(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return rename_map(rows, {"o_orderkey": "id", "o_orderpriority": "fraud_cat", "not there": "x"})


@query(
    "p03_to_int",
    over("SELECT id, CASE WHEN num_victims >= 2 THEN num_victims END AS num_victims FROM complaints_v"),
)
def p03(spark, sf_dir):
    text = F.expr("CASE num_victims WHEN 0 THEN ' ' WHEN 1 THEN 'x1' ELSE concat(' ', num_victims, ' ') END")
    return complaints(spark, sf_dir, "id", "num_victims").select("id", to_int(text).alias("num_victims"))


@query(
    "p04_to_money",
    over(
        """SELECT id, CASE WHEN gender <> 'P' THEN CAST(dollar_loss AS DOUBLE) END AS dollar_loss FROM complaints_v"""
    ),
)
def p04(spark, sf_dir):
    number = F.format_number("dollar_loss", 2)
    text = F.when(F.col("gender") == "P", F.concat(F.lit("($"), number, F.lit(")"))).otherwise(
        F.coalesce(F.concat(F.lit("$"), number), F.lit(" "))
    )
    rows = complaints(spark, sf_dir, "id", "gender", "dollar_loss").select("id", to_money(text).alias("dollar_loss"))
    return decimals_to_double(rows)


@query("p05_to_day", over("SELECT id, CASE WHEN gender <> 'P' THEN date END AS date FROM complaints_v"))
def p05(spark, sf_dir):
    text = F.when(F.col("gender") == "P", F.date_format("date", "yyyy/MM/dd")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    return complaints(spark, sf_dir, "id", "date", "gender").select("id", to_day(text).alias("date"))


@query("p06_select_cols", over("SELECT province, id, gender FROM complaints_v"))
def p06(spark, sf_dir):
    return select_cols(complaints(spark, sf_dir), ["province", "id", "gender"])


@query("p07_numeric_cols_except", "SELECT p_size, p_retailprice FROM part")
def p07(spark, sf_dir):
    return numeric_cols_except(table(spark, sf_dir, "part"), ["p_partkey"])


@query(
    "p08_period_keys",
    over(
        """SELECT id, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
                  strftime(date, '%Y-%m') AS year_month FROM complaints_v"""
    ),
)
def p08(spark, sf_dir):
    return period_keys(complaints(spark, sf_dir, "id", "date"), "date")


@query("p09_month_start", over("SELECT id, CAST(date_trunc('month', date) AS DATE) AS month_date FROM complaints_v"))
def p09(spark, sf_dir):
    return complaints(spark, sf_dir, "id", "date").select("id", month_start(F.year("date"), F.month("date")).alias("month_date"))


@query(
    "p10_quarter_label",
    over(
        """SELECT id, CAST((month(date) - 1) // 3 + 1 AS INTEGER) AS quarter_no,
                  year(date) || '_Q' || ((month(date) - 1) // 3 + 1) AS label FROM complaints_v"""
    ),
)
def p10(spark, sf_dir):
    rows = complaints(spark, sf_dir, "id", "date")
    return rows.select("id", F.quarter("date").alias("quarter_no"), quarter_label("date").alias("label"))


@query(
    "p11_month_name",
    over("SELECT id, strftime(date, '%B') AS month_name, strftime(date, '%B %Y') AS month_and_year FROM complaints_v"),
)
def p11(spark, sf_dir):
    return complaints(spark, sf_dir, "id", "date").select(
        "id", month_name("date").alias("month_name"), month_name("date", True).alias("month_and_year")
    )


@query(
    "p12_rate_per",
    over(
        """SELECT province, n, CAST(n AS DOUBLE) / (population * 1000) * 100000 AS rate_per_100k
           FROM (SELECT province, count(*) AS n FROM complaints_v WHERE province IS NOT NULL GROUP BY 1)
                LEFT JOIN population_v USING (province)""",
        POPULATION,
    ),
)
def p12(spark, sf_dir):
    counts = freq(complaints(spark, sf_dir, "province"), "province").join(population(spark, sf_dir), "province", "left")
    return counts.select("province", "n", rate_per("n", "population").alias("rate_per_100k"))


@query(
    "p13_scale",
    over(
        """SELECT year, CAST(sum(total_loss) AS DOUBLE) / 1000000.0 AS loss_millions,
                  CAST(sum(total_victims) AS DOUBLE) / 1000.0 AS victims_thousands FROM monthly_v GROUP BY year""",
        MONTHLY,
    ),
)
def p13(spark, sf_dir):
    return yearly_summary(complaints(spark, sf_dir, *KEYS)).select(
        "year", scale("total_loss", 1e6).alias("loss_millions"), scale("total_victims", 1e3).alias("victims_thousands")
    )


@query(
    "p14_bracket",
    over(
        """SELECT id, CAST(CASE WHEN dollar_loss <= 0 THEN NULL WHEN dollar_loss <= 100 THEN 1 WHEN dollar_loss <= 500 THEN 2
                  WHEN dollar_loss <= 1000 THEN 3 WHEN dollar_loss <= 5000 THEN 4 WHEN dollar_loss <= 10000 THEN 5
                  WHEN dollar_loss > 10000 THEN 6 END AS INTEGER) AS bracket_no,
                  CASE WHEN dollar_loss <= 0 THEN NULL WHEN dollar_loss <= 100 THEN '$1-100'
                  WHEN dollar_loss <= 500 THEN '$101-500' WHEN dollar_loss <= 1000 THEN '$501-1000'
                  WHEN dollar_loss <= 5000 THEN '$1001-5000' WHEN dollar_loss <= 10000 THEN '$5001-10000'
                  WHEN dollar_loss > 10000 THEN '>$10000' END AS bracket FROM complaints_v"""
    ),
)
def p14(spark, sf_dir):
    return complaints(spark, sf_dir, "id", "dollar_loss").select(
        "id", bracket_no("dollar_loss").alias("bracket_no"), bracket_label("dollar_loss").alias("bracket")
    )


@query(
    "p15_label_if",
    over(
        """SELECT id, CASE WHEN dollar_loss > 300000 THEN 'major' WHEN dollar_loss > 150000 THEN 'large'
                  ELSE 'moderate' END AS size, CASE WHEN province = 'NATION_3' THEN 'Region' ELSE 'Other' END AS place
           FROM complaints_v"""
    ),
)
def p15(spark, sf_dir):
    loss = F.col("dollar_loss")
    size = label_if([(loss > 300000, "major"), (loss > 150000, "large")], "moderate")
    place = label_if([(F.col("province") == "NATION_3", "Region")], "Other")
    return complaints(spark, sf_dir, "id", "dollar_loss", "province").select("id", size.alias("size"), place.alias("place"))


@query(
    "p16_number_display",
    over(
        """SELECT month_date, format('{:,}', total_victims) AS victims,
                  '$' || format('{:,}', CAST(round_even(CAST(total_loss AS DOUBLE), 0) AS BIGINT)) AS loss,
                  CASE WHEN round(pct, 1) > 0 THEN '+' ELSE '' END || printf('%.1f', round(pct, 1)) || '%' AS change,
                  printf('%.2f', round(times, 2)) || 'x' AS times FROM moved""",
        MONTHLY,
        """moved AS (SELECT month_date, total_loss, total_victims,
              (CAST(total_victims AS DOUBLE) - lag(total_victims) OVER (ORDER BY month_date))
              / nullif(lag(total_victims) OVER (ORDER BY month_date), 0) * 100 AS pct,
              CAST(total_victims AS DOUBLE) / 100 AS times FROM monthly_v)""",
    ),
)
def p16(spark, sf_dir):
    monthly = yoy(with_month(monthly_summary(complaints(spark, sf_dir, *KEYS))), "month_date", "total_victims")
    return monthly.select(
        "month_date",
        fmt_count("total_victims").alias("victims"),
        fmt_money("total_loss").alias("loss"),
        fmt_pct("yoy_pct_change", 1, signed=True).alias("change"),
        fmt_times(scale("total_victims", 100)).alias("times"),
    )


@query(
    "p17_rounded",
    over(
        """SELECT province, round(CAST(sum(CASE WHEN gender = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 1)
                  AS pct FROM complaints_v GROUP BY province"""
    ),
)
def p17(spark, sf_dir):
    shares = complaints(spark, sf_dir, "province", "gender").groupBy("province")
    part = F.count_if(F.col("gender") == "F")
    return shares.agg(rounded(share_pct(part, F.count("*")), 1).alias("pct"))


@query(
    "p18_suffix",
    over("SELECT DISTINCT 'Latest Update : ' || year(date) || '_Q' || quarter(date) AS title FROM complaints_v"),
)
def p18(spark, sf_dir):
    path = F.format_string(output_path("/data", "%s", "").rstrip("/"), quarter_label("date"))
    title = F.concat_ws(" : ", F.lit("Latest Update"), suffix(path, 7))
    return complaints(spark, sf_dir, "date").select(title.alias("title")).distinct()


@query(
    "p19_link_html",
    """WITH t AS (SELECT page_id, replace(replace(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1),
                '&', '&amp;'), '<', '&lt;'), '''', '&#39;') AS title,
                replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '''', '&#39;') AS link FROM pages)
       SELECT page_id, '<a target=''_blank'' title=''' || title || ''' href=''' || link || ''' rel=''noopener''>' || title || '</a>'
              AS item FROM t""",
)
def p19(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", link_html(page_title("html"), "url").alias("item"))


@query(
    "p20_add_param",
    """SELECT page_id, split_part(url, '#', 1) || CASE WHEN instr(split_part(url, '#', 1), '?') > 1 THEN '&' ELSE '?' END
              || 'q=loss' || substr(url, length(split_part(url, '#', 1)) + 1) AS href FROM pages""",
)
def p20(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", add_param("url", "q", "loss").alias("href"))


@query(
    "p21_base_url",
    "SELECT page_id, split_part(url, '#', 1) AS base, instr(url, '#') = 0 AS is_document FROM pages",
)
def p21(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", base_url("url").alias("base"), is_document_url("url").alias("is_document")
    )
