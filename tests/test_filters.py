from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import final_plan, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportloom.operators import cleaning, filters, ranking
from reportloom.plans.bulletin import latest_quarter
from reportloom.sources.tables import complaints, table


def test_sentinel_drops_nulls_too(spark):
    rows = spark.createDataFrame([("Not Specified",), (None,), ("Canada",)], "country string")
    assert [r.country for r in filters.drop_sentinel(rows, "country", "Not Specified").collect()] == ["Canada"]


def test_choice_filter(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    pick = lambda values: sorted((r.c or "-") for r in filters.choice_filter(rows, "c", values).collect())
    assert pick([]) == ["-", "a", "b"] and pick(["a"]) == ["a"] and pick([None, "b"]) == ["-", "b"] and pick([None]) == ["-"]
    assert pick(["na"]) == []
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert filters.choice_filter(flags, "f", [True, "na"]).count() == 2


def test_range_filter_skips_text(spark):
    rows = spark.createDataFrame([("5",), ("x",), ("12.5",), (None,), ("NaN",)], "v string")
    assert sorted(r.v for r in filters.range_filter(rows, "v", 5, None).collect()) == ["12.5", "5"]
    assert filters.parse_range("1 ... 5") == ("1", "5") and filters.parse_range("... 5") == (None, "5")
    assert filters.parse_range("15") is None


def test_range_bounds_are_not_rounded_to_the_column(spark):
    rows = spark.createDataFrame([(1, Decimal("1.00")), (2, Decimal("1.01"))], "n int, m decimal(18,2)")
    assert [r.n for r in filters.range_filter(rows, "n", 1.5).collect()] == [2]
    assert [r.n for r in filters.range_filter(rows, "m", None, 1.005).collect()] == [1]
    days = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 2),), (None,)], "d date")
    assert filters.range_filter(days, "d", "2025-01-02", kind="date").count() == 1


def test_plain_search_needs_all_words(spark):
    rows = spark.createDataFrame([("Big Red fox",), ("red",), ("big",)], "t string")
    assert filters.column_search(rows, "t", "red BIG", regex=False).count() == 1
    assert filters.column_search(rows, "t", "red|BIG").count() == 3
    assert filters.column_search(rows, "t", "red", ignore_case=False).count() == 1


def test_a_pattern_of_blanks_is_a_pattern(spark):
    rows = spark.createDataFrame([("a b", 1), ("ab", 2), (None, 3)], "t string, n int")
    for search in (lambda *a, **k: filters.column_search(rows, "t", *a, **k), lambda *a, **k: filters.table_search(rows, *a, **k)):
        assert [r.n for r in search(" ").collect()] == [1]
        assert search("").count() == search(" ", regex=False).count() == 3


def test_table_search_looks_everywhere(spark):
    rows = spark.createDataFrame([(17, "a", None), (2, "x17", "b"), (3, "c", "d")], "n int, s string, t string")
    assert sorted(r.n for r in filters.table_search(rows, "17").collect()) == [2, 17]


def test_an_empty_query_keeps_everything(spark):
    rows = spark.createDataFrame([("a",), (None,)], "t string")
    for query, regex in (("", True), ("", False), ("  ", False)):
        assert filters.column_search(rows, "t", query, regex).count() == 2 and filters.table_search(rows, query, regex).count() == 2
        assert filters.column_search(rows, "t", query, regex=False).count() == 2


def test_tag_filter(spark):
    rows = spark.createDataFrame([("R,Spark",), ("Sparkling",), (None,)], "tags string")
    assert filters.tag_filter(rows, "tags", "Spark").count() == 1
    assert filters.tag_filter(rows, "tags", "").count() == 3


def test_facets(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "a", 9)], "k int, g string, v int")
    links = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "z")], "k int, h string")
    out = filters.facet_filter(rows, "k", {"g": ["a", "b"]}, {"v": (5, 6)}, [(links, "h", ["x", "y"])])
    assert sorted(r.k for r in out.collect()) == [1, 2]
    assert filters.facet_filter(rows, "k", {"g": []}, None, [(links, "h", [])]).count() == 3


def test_last_complete_year(spark):
    days = [(dt.date(2023, m, 1),) for m in range(1, 13)] + [(dt.date(2024, m, 1),) for m in range(1, 10)]
    rows = spark.createDataFrame(days, "d date")
    assert filters.last_complete_year(rows, "d") == 2023
    assert filters.until_year(rows, "d", 2023).count() == 12


def test_quarter_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "clean")
    complaints(spark, sf_dir, "id", "date").write.parquet(path)
    clean = spark.read.parquet(path)
    plan = final_plan(filters.in_quarter(clean, "date", 2000, 2))
    assert "GreaterThanOrEqual(date,2000-04-01)" in plan and "LessThan(date,2000-07-01)" in plan
    period = latest_quarter(clean)
    assert "GreaterThanOrEqual(o_orderdate" in final_plan(complaints(spark, sf_dir, "id", "date", period=period))


def test_unneeded_dimensions_are_not_joined(spark, sf_dir):
    assert "Join" not in final_plan(complaints(spark, sf_dir, "id", "date", "dollar_loss"))
    assert complaints(spark, sf_dir, "id").count() == complaints(spark, sf_dir).count()


def test_cleaning(spark):
    raw = spark.createDataFrame(
        [("1", "2025-01-02", "Canada", "2", "$1,000.50", "x"), ("2", "bad", "Not Specified", " ", "", "y")],
        "`Numero d'identification / Number ID` string, `Date Received / Date recue` string, Country string, "
        "`Number of Victims / Nombre de victimes` string, `Dollar Loss /pertes financieres` string, Pays string",
    )
    clean = cleaning.clean_reports(raw)
    assert clean.columns == ["id", "date", "country", "num_victims", "dollar_loss"]
    row = clean.collect()
    assert len(row) == 1 and row[0].num_victims == 2 and float(row[0].dollar_loss) == 1000.5
    assert cleaning.clean_reports(raw, None).count() == 2


def test_top_k_plan(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    assert "TakeOrderedAndProject" in final_plan(ranking.top_k(rows, "value", 3, "event_id"))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(0, 9), max_size=23), size=st.integers(1, 7))
def test_pages_make_up_the_sorted_table(spark, keys, size):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    whole = [tuple(r) for r in rows.orderBy("k", "i").collect()]
    paged, walked, last = [], [], None
    for number in range(1, -(-len(whole) // size) + 1):
        paged += [tuple(r) for r in ranking.page(rows, ["k", "i"], number, size).collect()]
        step = [tuple(r) for r in ranking.page_after(rows, ["k", "i"], last, size).collect()]
        walked, last = walked + step, step[-1]
    assert paged == whole and walked == whole


def test_ties_and_nulls_in_rank(spark):
    rows = spark.createDataFrame([("b", 5), ("a", 5), ("c", None)], "k string, m int")
    assert [r.k for r in ranking.rank_desc(rows, "m", "k").collect()] == ["a", "b", "c"]
    assert [r.k for r in ranking.recent(rows, "m", F.col("k").desc()).collect()] == ["b", "a", "c"]


@pytest.mark.parametrize("size", [1, 7, 100, 1000])
def test_pages_from_a_directory(spark, tmp_path, size):
    rng = random.Random(size)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(5)
    path, order = str(tmp_path / "pages"), [F.desc_nulls_last("k"), F.col("i")]
    ranking.write_pages(df, order, path)
    want = [tuple(r) for r in df.orderBy(*order).collect()]
    numbers = sorted({1, 2, 3, -(-400 // size), max(1, 200 // size)})
    for number in numbers:
        got = ranking.read_page(spark, path, number, size)
        assert [tuple(r) for r in got.collect()] == want[(number - 1) * size : number * size] and got.columns == ["k", "i"]
    assert ranking.read_page(spark, path, 401, size).count() == 0
    ranking.write_pages(df.limit(0), order, path)
    assert ranking.read_page(spark, path, 1, size).count() == 0


def test_a_deep_page_reads_its_range_only(spark, tmp_path):
    path = str(tmp_path / "pages")
    ranking.write_pages(spark.range(100_000).selectExpr("hash(id) AS k", "id"), ["k", "id"], path)
    page = ranking.read_page(spark, path, 1000, 10)
    plan = plan_of(page)
    assert "Limit" not in plan and "TakeOrdered" not in plan and "EqualTo(_range" in plan and "GreaterThanOrEqual(_place" in plan
    assert [tuple(r) for r in page.collect()] == [tuple(r) for r in spark.range(100_000).selectExpr("hash(id) AS k", "id").orderBy("k", "id").offset(9990).limit(10).collect()]
