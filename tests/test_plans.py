"""Plans that must stay lean."""

from __future__ import annotations

import datetime as dt

from conftest import final_plan, plan_of
from pyspark.sql import functions as F
from test_io import report, reports

from reportloom.catalog import QUERIES
from reportloom.catalog.sources import write_raw
from reportloom.operators import windows
from reportloom.operators.retrieval import index_documents
from reportloom.sources.tables import table
from reportloom.streaming import refresh


def test_cohort_seasons_read_orders_only(spark, sf_dir):
    plan = final_plan(QUERIES["e08_cohort_seasons"](spark, sf_dir))
    assert "orders.parquet" in plan and "customer.parquet" not in plan and "nation.parquet" not in plan


def test_local_regression_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0)], "g string, x int, y double")
    for by in ("g", None):
        plan = plan_of(windows.loess(df, "x", "y", by=by))
        assert "Pandas" not in plan and "Python" not in plan and "Join" not in plan


def test_an_index_is_made_without_a_shuffle(spark, sf_dir):
    index = index_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    assert "Exchange" not in plan_of(index)


def test_a_delivery_is_parsed_once(spark, tmp_path, monkeypatch):
    """Labels and rows come from the staged table, so the text is scanned for staging only."""
    run = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    write_raw(reports(spark, report(dt.date(2025, 2, 1), 1, 1), report(dt.date(2025, 5, 1), 2, 2)), f"{run[0]}/a")
    seen = []
    monkeypatch.setattr(refresh, "_replace", lambda df, path, make=refresh._replace: (seen.append(plan_of(df)), make(df, path)))
    refresh.refresh_summaries(spark, *run)
    assert len(seen) == 2 and all("parquet" in plan and "csv" not in plan for plan in seen)
    assert refresh.read_monthly(spark, run[1]).agg(F.sum("total_victims")).first()[0] == 3
