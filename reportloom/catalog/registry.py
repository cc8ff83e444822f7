"""Registry and the SQL shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

COMPLAINTS = """complaints_v AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, r_name AS country, n_name AS province,
         o_orderpriority AS fraud_cat, c_mktsegment AS sol_method, o_orderstatus AS gender,
         CASE WHEN o_orderkey % 11 = 0 THEN '''Not Available / non disponible'
              ELSE concat('''', CAST(10 * (o_custkey % 8 + 1) AS VARCHAR), ' - ',
                          CAST(10 * (o_custkey % 8 + 1) + 9 AS VARCHAR)) END AS age_range,
         CAST(o_orderkey % 4 AS INTEGER) AS num_victims,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS dollar_loss
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

POPULATION = """population_v AS (
  SELECT n_name AS province, CAST(count(*) AS DOUBLE) AS population
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""

MONTHLY = """monthly_v AS (
  SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         make_date(year(date), month(date), 1) AS month_date,
         sum(dollar_loss) AS total_loss, CAST(sum(num_victims) AS BIGINT) AS total_victims
  FROM complaints_v GROUP BY ALL)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it gets a rows-only check and a brute-force test instead."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def over(body: str, *views: str) -> str:
    """SQL over the report view and further views built on it."""
    return f"WITH {', '.join((COMPLAINTS, *views))}\n{body}"
