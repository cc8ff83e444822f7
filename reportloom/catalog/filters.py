"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import freq, sum_by
from ..operators.filters import (
    choice_filter,
    column_search,
    drop_sentinel,
    dropna_keys,
    facet_filter,
    facet_range,
    having,
    keep_in,
    keep_not_in,
    last_complete_year,
    not_like,
    parse_range,
    positive,
    range_filter,
    slice_rows,
    table_search,
    tag_filter,
    until_year,
)
from ..operators.ranking import top_k
from ..plans.bulletin import latest_quarter
from ..sources.tables import complaints, table
from .registry import over, query

SENTINEL = "4-NOT SPECIFIED"
REGION = "NATION_3"
COHORT = "'10 - 19"
NEWEST_QUARTER = """quarter_v AS (SELECT * FROM complaints_v
  WHERE date_trunc('quarter', date) = (SELECT max(date_trunc('quarter', date)) FROM complaints_v))"""


def newest_quarter(spark, sf_dir, *wanted):
    """Reports of the latest quarter, cut at the scan."""
    period = latest_quarter(complaints(spark, sf_dir, "date"))
    return complaints(spark, sf_dir, *wanted, period=period)


@query("f01_drop_sentinel", over(f"SELECT id, fraud_cat FROM complaints_v WHERE fraud_cat <> '{SENTINEL}'"))
def f01(spark, sf_dir):
    return drop_sentinel(complaints(spark, sf_dir, "id", "fraud_cat"), "fraud_cat", SENTINEL)


@query(
    "f02_slice_rows",
    over("SELECT id, province, age_range FROM complaints_v WHERE province = 'NATION_3' AND age_range = '''10 - 19'"),
)
def f02(spark, sf_dir):
    return slice_rows(complaints(spark, sf_dir, "id", "province", "age_range"), province=REGION, age_range=COHORT)


@query("f03_in_quarter", over("SELECT id, date, fraud_cat FROM quarter_v", NEWEST_QUARTER))
def f03(spark, sf_dir):
    return newest_quarter(spark, sf_dir, "id", "date", "fraud_cat")


@query("f04_keep_in", over("SELECT id, fraud_cat FROM complaints_v WHERE fraud_cat IN ('1-URGENT', '2-HIGH')"))
def f04(spark, sf_dir):
    return keep_in(complaints(spark, sf_dir, "id", "fraud_cat"), "fraud_cat", ["1-URGENT", "2-HIGH"])


@query(
    "f05_keep_not_in",
    over("SELECT sol_method, count(*) AS n FROM complaints_v WHERE sol_method NOT IN ('MACHINERY', 'FURNITURE') GROUP BY 1"),
)
def f05(spark, sf_dir):
    return keep_not_in(freq(complaints(spark, sf_dir, "sol_method"), "sol_method"), "sol_method", ["MACHINERY", "FURNITURE"])


@query(
    "f06_not_like",
    over(
        """SELECT id, age_range FROM complaints_v
           WHERE age_range NOT LIKE '%Not Available%' AND age_range NOT LIKE '%non disponible%'"""
    ),
)
def f06(spark, sf_dir):
    return not_like(complaints(spark, sf_dir, "id", "age_range"), "age_range")


@query(
    "f07_having",
    over(
        """SELECT province, count(*) AS n FROM complaints_v WHERE province IS NOT NULL GROUP BY 1
           HAVING count(*) > (SELECT count(*) FROM complaints_v) * 0.04"""
    ),
)
def f07(spark, sf_dir):
    counts = freq(complaints(spark, sf_dir, "province"), "province")
    total = complaints(spark, sf_dir, "id").agg(F.count("*")).scalar()
    return having(counts, F.col("n") > total * F.lit(0.04))


@query("f08_positive", over("SELECT id, CAST(dollar_loss AS DOUBLE) AS dollar_loss FROM complaints_v WHERE dollar_loss > 0"))
def f08(spark, sf_dir):
    rows = positive(complaints(spark, sf_dir, "id", "dollar_loss"), "dollar_loss")
    return rows.withColumn("dollar_loss", F.col("dollar_loss").cast("double"))


@query(
    "f09_until_year",
    over(
        """SELECT id, date FROM complaints_v WHERE year(date) <= (SELECT max(y) FROM (SELECT year(date) AS y
           FROM complaints_v GROUP BY 1 HAVING count(DISTINCT month(date)) = 12))"""
    ),
)
def f09(spark, sf_dir):
    rows = complaints(spark, sf_dir, "id", "date")
    return until_year(rows, "date", last_complete_year(rows, "date"))


@query(
    "f10_dropna_keys",
    over(
        """SELECT * FROM (SELECT nullif(fraud_cat, '4-NOT SPECIFIED') AS cat, CAST(sum(dollar_loss) AS DOUBLE) AS total
           FROM complaints_v GROUP BY 1 ORDER BY total DESC, cat NULLS FIRST LIMIT 3) WHERE cat IS NOT NULL"""
    ),
)
def f10(spark, sf_dir):
    cat = F.nullif(F.col("fraud_cat"), F.lit(SENTINEL))
    totals = sum_by(complaints(spark, sf_dir, "fraud_cat", "dollar_loss").withColumn("cat", cat), "cat", "dollar_loss")
    return dropna_keys(top_k(totals, "total", 3, "cat"), "cat").withColumn("total", F.col("total").cast("double"))


@query(
    "f11_range_filter",
    """SELECT event_id, ts, value FROM events WHERE value BETWEEN 5 AND 50.5
       AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
)
def f11(spark, sf_dir):
    low, high = parse_range("5 ... 50.5")
    rows = range_filter(table(spark, sf_dir, "events").select("event_id", "ts", "value"), "value", low, high)
    return range_filter(rows, "ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00", kind="timestamp")


@query(
    "f12_choice_filter",
    over(
        """SELECT id, dollar_loss > 200000 AS high FROM complaints_v
           WHERE (dollar_loss > 200000 OR dollar_loss IS NULL) AND fraud_cat IN ('1-URGENT', '5-LOW')"""
    ),
)
def f12(spark, sf_dir):
    rows = complaints(spark, sf_dir, "id", "dollar_loss", "fraud_cat").withColumn("high", F.col("dollar_loss") > 200000)
    rows = choice_filter(choice_filter(rows, "fraud_cat", ["1-URGENT", "5-LOW"]), "high", [True, "na"])
    return choice_filter(rows, "id", []).select("id", "high")


@query(
    "f13_column_search",
    """SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '(the|des) \\w+ti', 'i')
       AND contains(lower(text), 'an') AND contains(lower(text), 'le')""",
)
def f13(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = column_search(rows, "text", r"(the|des) [0-9A-Za-z_]+ti")
    return column_search(rows, "text", "AN le", regex=False).drop("text")


@query(
    "f14_table_search",
    """SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
       WHERE regexp_matches(CAST(c_custkey AS VARCHAR), 'build|77', 'i') OR regexp_matches(c_name, 'build|77', 'i')
             OR regexp_matches(CAST(c_nationkey AS VARCHAR), 'build|77', 'i') OR regexp_matches(c_mktsegment, 'build|77', 'i')""",
)
def f14(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return table_search(rows, "build|77")


@query("f15_tag_filter", "SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'ring')")
def f15(spark, sf_dir):
    return tag_filter(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "ring", " ")


@query(
    "f16_facet_filter",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')
             AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
             AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('R', 'A'))""",
)
def f16(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    moment = dict(orders.dtypes)["o_orderdate"]
    dates = tuple(F.lit(day).cast(moment) for day in ("1996-01-01", "1998-12-31"))
    return facet_filter(
        orders,
        "o_orderkey",
        choices={"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": ["F", "O"]},
        ranges={"o_orderdate": dates},
        linked=[(lines, "l_returnflag", ["R", "A"]), (lines, "l_linestatus", [])],
    ).drop("o_orderdate")


@query("f17_facet_range", "SELECT event_id, value FROM events WHERE value BETWEEN 10 AND 20")
def f17(spark, sf_dir):
    return facet_range(table(spark, sf_dir, "events").select("event_id", "value"), "value", 10, 20)
