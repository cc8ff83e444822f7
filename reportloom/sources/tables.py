"""The star-schema tables seen as the clean report table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FROM_ORDERS = {
    "id": "o_orderkey",
    "date": "CAST(o_orderdate AS DATE)",
    "fraud_cat": "o_orderpriority",
    "gender": "o_orderstatus",
    "age_range": "CASE WHEN o_orderkey % 11 = 0 THEN '\\'Not Available / non disponible'"
    " ELSE concat('\\'', CAST(10 * (o_custkey % 8 + 1) AS STRING), ' - ', CAST(10 * (o_custkey % 8 + 1) + 9 AS STRING)) END",
    "num_victims": "CAST(o_orderkey % 4 AS INT)",
    "dollar_loss": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END",
}
FROM_CUSTOMER = {"sol_method": "c_mktsegment"}
FROM_REGION = {"province": "n_name", "country": "r_name"}
CLEAN_COLUMNS = [*FROM_ORDERS, *FROM_CUSTOMER, *FROM_REGION]


def complaints(
    spark: SparkSession, sf_dir: str, *wanted: str, period: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """Orders as reports: the order is the report, its customer gives method and region.

    Only the dimensions that the wanted columns need are joined. Dimension keys are unique and the
    joins are left joins, so leaving one out never changes the number of rows. `period` is a
    half-open date range applied to the raw timestamp, where the Parquet scan can use it.
    """
    wanted = wanted or tuple(CLEAN_COLUMNS)
    rows = table(spark, sf_dir, "orders")
    if period is not None:
        start, end = (dt.datetime.combine(day, dt.time()) for day in period)
        moment = dict(rows.dtypes)["o_orderdate"]
        rows = rows.filter(
            (F.col("o_orderdate") >= F.lit(start).cast(moment)) & (F.col("o_orderdate") < F.lit(end).cast(moment))
        )
    needs_region = any(c in FROM_REGION for c in wanted)
    if needs_region or any(c in FROM_CUSTOMER for c in wanted):
        customer = table(spark, sf_dir, "customer")
        rows = rows.join(customer, rows.o_custkey == customer.c_custkey, "left")
        if needs_region:
            nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
            places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            rows = rows.join(places, rows.c_nationkey == places.n_nationkey, "left")
    formula = FROM_ORDERS | FROM_CUSTOMER | FROM_REGION
    return rows.select(*[F.expr(formula[c]).alias(c) for c in wanted])


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residents per province, in thousands: here, customers per nation."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    counts = customer.groupBy("c_nationkey").agg(F.count("*").cast("double").alias("population"))
    return counts.join(nation, counts.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("province"), "population"
    )
