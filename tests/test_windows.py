from __future__ import annotations

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from golden import MONTHLY, YEARLY
from pyspark.sql import functions as F

from reportloom.operators import aggregates, windows
from reportloom.plans import bulletin


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [(2021 + i // 12, i % 12 + 1, Decimal(str(loss)), victims) for i, (loss, victims) in enumerate(MONTHLY)]
    df = spark.createDataFrame(rows, "year int, month int, total_loss decimal(18,2), total_victims bigint")
    return aggregates.with_month(df)


def test_yearly_from_monthly_matches_published(monthly):
    got = {r.year: (float(r.total_loss), r.total_victims) for r in aggregates.yearly_from_monthly(monthly).collect()}
    assert got.keys() == YEARLY.keys()
    for year, (loss, victims) in YEARLY.items():
        assert got[year][0] == pytest.approx(loss, abs=0.01) and got[year][1] == victims


def test_rolling_mean_matches_published(monthly):
    rolled = windows.rolling_mean(monthly, "month_date", {"total_loss": "loss", "total_victims": "victims"})
    got = {r.month_date: r for r in rolled.collect()}
    assert got[dt.date(2025, 9, 1)].loss == pytest.approx(53018394.21, abs=0.01) and got[dt.date(2025, 9, 1)].victims == 1657.0
    assert got[dt.date(2021, 1, 1)].loss == pytest.approx(12894119.87)
    assert got[dt.date(2021, 2, 1)].loss == pytest.approx(19968081.57, abs=0.01)


def test_peaks_match_published(monthly):
    assert windows.peak(monthly, "total_loss", "month_date").first().month_date == dt.date(2025, 7, 1)
    found = windows.peak_divergence(monthly, "total_loss", "total_victims", "month_date").first()
    assert float(found.peak_total_loss) == 71739167.57 and found.peak_total_loss_date == dt.date(2025, 7, 1)
    assert found.peak_total_victims == 6111 and found.peak_total_victims_date == dt.date(2021, 3, 1)
    assert found.divergence == "strong divergence"


def test_first_of_several_peaks_wins(spark):
    rows = [("s", dt.date(2021, 2, 1), 5, None), ("s", dt.date(2021, 1, 1), 5, 2), ("t", dt.date(2021, 3, 1), None, 2)]
    df = spark.createDataFrame(rows, "g string, d date, m int, n int")
    assert windows.peak(df, "m", "d").first().d == dt.date(2021, 1, 1)
    assert {r.g: r.d for r in windows.peak(df, "m", "d", by=["g"]).collect()} == {"s": dt.date(2021, 1, 1), "t": dt.date(2021, 3, 1)}
    both = windows.peak_divergence(df, "m", "n", "d").first()
    assert both.peak_m_date == both.peak_n_date == dt.date(2021, 1, 1) and both.divergence == "parallel spike"


def test_rolling_frame_counts_rows_not_months(spark):
    rows = [(dt.date(2021, m, 1), v) for m, v in ((1, 1), (2, 2), (4, 6))]
    df = spark.createDataFrame(rows, "d date, v int")
    assert [r.r for r in windows.rolling_mean(df, "d", {"v": "r"}).orderBy("d").collect()] == [1.0, 1.5, 3.0]
    filled = windows.fill_months(df, "d", ["v"])
    assert [r.r for r in windows.rolling_mean(filled, "d", {"v": "r"}).orderBy("d").collect()][-1] == pytest.approx(8 / 3)


def test_yoy(spark):
    df = spark.createDataFrame([(2021, 100), (2022, 25), (2023, 0), (2024, 5)], "y int, n int")
    got = [(r.yoy_change, r.yoy_pct_change) for r in windows.yoy(df, "y", "n").orderBy("y").collect()]
    assert got == [(None, None), (-75, -75.0), (-25, -100.0), (5, None)]


def test_percentages_sum_to_hundred(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 7)], "a string, b string, n int")
    sums = windows.row_pct(df, "a").groupBy("a").agg(F.sum("pct").alias("s")).collect()
    assert [r.s for r in sums] == [pytest.approx(100)] * 2
    assert windows.pct_total(df).agg(F.sum("pct")).first()[0] == pytest.approx(100)


def brute_loess(xs, ys, span):
    near = min(len(xs), max(2, int(np.floor(span * len(xs) + 1e-5))))
    out = []
    for at in xs:
        gap = np.abs(xs - at)
        reach = np.sort(gap)[near - 1]
        w = np.where(gap < reach, (1 - (gap / reach) ** 3) ** 3, 0)
        a = np.vstack([np.ones_like(xs), xs - at, (xs - at) ** 2]).T
        out.append(np.linalg.solve(a.T @ (w[:, None] * a), a.T @ (w * ys))[0])
    return out


def test_loess_against_normal_equations(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for series, n in (("p", 40), ("q", 15)):
        xs = np.sort(rng.choice(200, n, replace=False)).astype(float)
        ys = xs**1.5 + rng.normal(0, 20, n)
        want.update({(series, int(x)): t for x, t in zip(xs, brute_loess(xs, ys, 0.6))})
        rows += [(series, int(x), float(y)) for x, y in zip(xs, ys)]
    rows.append(("p", None, 1.0))
    df = spark.createDataFrame(rows, "s string, x int, y double")
    got = {(r.s, r.x): r.trend for r in windows.loess(df, "x", "y", by="s", span=0.6).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)


def test_loess_follows_a_parabola(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(20)], "x int, y double")
    assert all(r.trend == pytest.approx(r.y, abs=1e-6) for r in windows.loess(df, "x", "y").collect())
    one = windows.loess(spark.createDataFrame([(1, 3.0)], "x int, y double"), "x", "y").collect()
    assert [r.trend for r in one] == [pytest.approx(3.0)]


def test_bulletin_facts(spark):
    rows = [("c", dt.date(2025, 7, 3), Decimal("2000.50"), 1), ("c", dt.date(2025, 8, 4), Decimal("10"), 1500), ("d", dt.date(2024, 1, 1), None, None)]
    df = spark.createDataFrame(rows, "fraud_cat string, date date, dollar_loss decimal(18,2), num_victims int")
    facts = bulletin.bulletin_facts(df, "centre").first()
    assert (facts.label, facts.min_date, facts.max_date) == ("2025_Q3", dt.date(2024, 1, 1), dt.date(2025, 8, 4))
    assert (facts.peak_loss, facts.loss_month, facts.peak_victims, facts.victims_month) == ("$2,000", "July 2025", "1,500", "August 2025")
    assert facts.narrative.startswith("In 2025_Q3, the centre recorded its highest monthly financial loss in July 2025 at $2,000. ")
    assert "a strong divergence" in facts.narrative


def test_top_categories_with_a_null_category(spark):
    day = dt.date(2025, 7, 3)
    rows = [(None, day, 9), ("a", day, 5), ("b", day, 4), ("c", day, 3)]
    df = spark.createDataFrame(rows, "fraud_cat string, date date, dollar_loss int")
    assert [r.fraud_cat for r in bulletin.top_categories(df).collect()] == ["a", "b"]
    assert {r.fraud_cat for r in bulletin.category_trend(df).collect()} == {"a", "b"}
    assert bulletin.category_matrix(df).columns == ["month_date", "a", "b"]
