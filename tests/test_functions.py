from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reportloom.functions import links, numbers, parsing, periods


def values(spark, inputs, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [row.out for row in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_to_int(spark):
    assert values(spark, ["12", " ", "x", None, "1.5", " 7 "], "string", parsing.to_int) == [12, None, None, None, None, 7]


def test_to_money(spark):
    got = values(spark, ["$1,234.50", "($5)", "-$3", "", "N/A", " $7 ", None], "string", parsing.to_money)
    assert got == [Decimal("1234.50"), None, Decimal("-3.00"), None, None, Decimal("7.00"), None]
    large = ["$99,999,999,999,999,999.00", "$1.005"]
    assert values(spark, large, "string", parsing.to_money) == [Decimal("99999999999999999"), Decimal("1.005")]


def test_rejected_money_is_counted(spark):
    df = spark.createDataFrame([("$1",), ("x",), (" ",), (None,), ("($5)",)], "v string")
    assert df.agg(parsing.money_rejects("v")).first()[0] == 2


def test_to_day(spark):
    got = values(spark, ["2025-09-30", "2025-9-3", "bad", "", None], "string", parsing.to_day)
    assert got == [dt.date(2025, 9, 30), None, None, None, None]


def test_to_feed_time(spark):
    texts = ["Mon, 01 Sep 2025 00:00:00 -0400", "2 Sep 2025 10:30:00 +0000", "Tue, 9 Sep 2025 01:02:03 GMT", "soon", None]
    got = values(spark, texts, "string", lambda c: F.date_format(parsing.to_feed_time(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2025-09-01 04:00:00", "2025-09-02 10:30:00", "2025-09-09 01:02:03", None, None]


def test_all_forms_of_feed_dates(spark):
    forms = {
        "Wed, 02 Oct 2024 13:00:00 EST": "2024-10-02 18:00:00", "Wed, 02 Oct 2024 13:00:00 PDT": "2024-10-02 20:00:00",
        "2 Oct 24 13:00 GMT": "2024-10-02 13:00:00", "2 Oct 94 13:00 UT": "1994-10-02 13:00:00", "2 Oct 124 13:00 Z": "2024-10-02 13:00:00",
        "Wednesday, 2 October 2024 3:05 +02:00": "2024-10-02 01:05:00", "wed 2-OCT-2024 03:05:09 cdt": "2024-10-02 08:05:09",
        " Wed,  02 Oct 2024\n13:00:00 (noon (ish)) +0000 ": None, "Wed, 02 Oct 2024 13:00:00 (noon) +0000": "2024-10-02 13:00:00",
        "02 Oct 2024 13:00:00.250 M": "2024-10-02 13:00:00", "02 Oct 2024 13:00:00 J": None, "02 Oct 2024 13:00:00": None,
        "02 Oct 2024 13:00:00 XYZ": None, "31 Feb 2024 13:00:00 GMT": None, "02 Okt 2024 13:00:00 GMT": None, "2024-10-02": None,
        "Wed, 02 Oct 2024 25:00:00 GMT": None, "": None, "  ": None, "02 Oct 49 00:00 +1400": "2049-10-01 10:00:00",
    }
    got = values(spark, list(forms), "string", lambda c: F.date_format(parsing.to_feed_time(c), "yyyy-MM-dd HH:mm:ss"))
    assert dict(zip(forms, got)) == forms
    df = spark.createDataFrame([(f,) for f in forms] + [(None,)], "v string")
    assert df.agg(parsing.feed_time_rejects("v")).first()[0] == sum(w is None and bool(f.strip()) for f, w in forms.items())


def test_let_binds_once(spark):
    assert values(spark, [3], "int", lambda c: parsing.let(c + 1, lambda v: v * v)) == [16]


@pytest.mark.parametrize(
    "quarter, bounds",
    [(1, ((2024, 1, 1), (2024, 4, 1))), (3, ((2024, 7, 1), (2024, 10, 1))), (4, ((2024, 10, 1), (2025, 1, 1)))],
)
def test_quarter_bounds(quarter, bounds):
    assert periods.quarter_bounds(2024, quarter) == tuple(dt.date(*b) for b in bounds)


def test_period_labels(spark):
    day = [dt.date(2025, 9, 30)]
    assert values(spark, day, "date", periods.quarter_label) == ["2025_Q3"]
    assert values(spark, day, "date", periods.month_name) == ["September"]
    assert values(spark, day, "date", lambda c: periods.month_name(c, True)) == ["September 2025"]
    assert values(spark, day, "date", lambda c: periods.month_start(F.year(c), F.month(c))) == [dt.date(2025, 9, 1)]


def test_brackets(spark):
    money = [Decimal(v) if v else None for v in "0 0.01 100 100.01 500 1000 5000 10000 10000.01 -5".split()] + [None]
    assert values(spark, money, "decimal(18,2)", numbers.bracket_no) == [None, 1, 1, 2, 2, 3, 4, 5, 6, None, None]
    assert values(spark, money, "decimal(18,2)", numbers.bracket_label)[:3] == [None, "$1-100", "$1-100"]


def test_rates_and_shares(spark):
    assert values(spark, [39], "int", lambda c: numbers.rate_per(c, F.lit(100.0))) == [39.0]
    assert values(spark, [1], "int", lambda c: numbers.share_pct(c, F.lit(0))) == [None]
    assert values(spark, [5], "int", lambda c: numbers.change_pct(F.lit(20), c)) == [-75.0]


def test_number_display(spark):
    assert values(spark, [1234567], "int", numbers.fmt_count) == ["1,234,567"]
    assert values(spark, [71739167.57], "double", numbers.fmt_money) == ["$71,739,168"]
    assert values(spark, [12.34, -5.0, None], "double", lambda c: numbers.fmt_pct(c, 1, True)) == ["+12.3%", "-5.0%", None]
    assert values(spark, [1.234], "double", numbers.fmt_times) == ["1.23x"]


def test_add_param(spark):
    urls = ["a?x=1#f", "a#f", "a", "?x", "a#f#g"]
    got = values(spark, urls, "string", lambda c: links.add_param(c, "q", "1"))
    assert got == ["a?x=1&q=1#f", "a?q=1#f", "a?q=1", "?x?q=1", "a?q=1#f#g"]


def test_link_html_escapes(spark):
    got = values(spark, ["a<b & 'c'"], "string", lambda c: links.link_html(c, F.lit("u?x=1&y")))
    text = "a&lt;b &amp; &#39;c&#39;"
    assert got == [f"<a target='_blank' title='{text}' href='u?x=1&amp;y' rel='noopener'>{text}</a>"]


def test_suffix_and_base(spark):
    assert values(spark, ["/x/outputs_2025_Q3"], "string", links.suffix) == ["2025_Q3"]
    assert values(spark, ["p.html#s", "p.html"], "string", links.base_url) == ["p.html", "p.html"]
    assert values(spark, ["p.html#s", "p.html"], "string", links.is_document_url) == [False, True]
