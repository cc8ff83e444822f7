"""Sort, limit, top-k, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import decimals_to_double
from ..operators.aggregates import freq, monthly_summary, sum_by
from ..operators.ranking import order_periods, page, page_after, rank_desc, read_page, recent, sample_head, top_k, write_pages
from ..plans.bulletin import top_categories
from ..plans.site_search import listing
from ..sources.tables import complaints, table
from .filters import NEWEST_QUARTER, newest_quarter
from ..workspace import fresh_dir
from .registry import MONTHLY, over, query


@query("l01_order_periods", over("SELECT year, month, total_victims FROM monthly_v ORDER BY year, month", MONTHLY))
def l01(spark, sf_dir):
    monthly = monthly_summary(complaints(spark, sf_dir, "date", "dollar_loss", "num_victims"))
    return order_periods(monthly, "year", "month").drop("total_loss")


@query(
    "l02_rank_desc",
    over("SELECT province, count(*) AS n FROM complaints_v WHERE province IS NOT NULL GROUP BY 1 ORDER BY n DESC, province"),
)
def l02(spark, sf_dir):
    return rank_desc(freq(complaints(spark, sf_dir, "province"), "province"), "n", "province")


@query(
    "l03_top_k",
    over(
        """SELECT province, CAST(sum(dollar_loss) AS DOUBLE) AS total FROM complaints_v GROUP BY 1
           ORDER BY sum(dollar_loss) DESC NULLS LAST, province LIMIT 10"""
    ),
)
def l03(spark, sf_dir):
    totals = sum_by(complaints(spark, sf_dir, "province", "dollar_loss"), "province", "dollar_loss")
    return decimals_to_double(top_k(totals, "total", 10, "province"))


@query(
    "l03_top_categories",
    over(
        """SELECT fraud_cat, CAST(sum(dollar_loss) AS DOUBLE) AS loss_total FROM quarter_v GROUP BY 1
           ORDER BY sum(dollar_loss) DESC NULLS LAST, fraud_cat LIMIT 3""",
        NEWEST_QUARTER,
    ),
)
def l03_categories(spark, sf_dir):
    return decimals_to_double(top_categories(newest_quarter(spark, sf_dir, "fraud_cat", "dollar_loss")))


@query("l04_sample_head", over("SELECT id, date, province FROM complaints_v ORDER BY date, id LIMIT 6"))
def l04(spark, sf_dir):
    return sample_head(complaints(spark, sf_dir, "id", "date", "province"), "date", "id")


@query("l05_recent", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id")
def l05(spark, sf_dir):
    return recent(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), "ts", "event_id")


@query(
    "l05_listing",
    """SELECT p_partkey, p_name, p_retailprice FROM part WHERE list_contains(string_split(p_name, ' '), 'small')
       ORDER BY p_retailprice DESC, p_partkey""",
)
def l05_listing(spark, sf_dir):
    items = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("tags"), "p_name", "p_retailprice")
    return listing(items, "tags", "small", "p_retailprice", "p_partkey").drop("tags")


@query("l06_page", "SELECT event_id, user_id, value FROM events ORDER BY user_id, event_id LIMIT 25 OFFSET 50")
def l06(spark, sf_dir):
    return page(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), ["user_id", "event_id"], 3, 25)


@query(
    "l06_page_after",
    """SELECT event_id, user_id, value FROM events WHERE (user_id, event_id) > (20, 500)
       ORDER BY user_id, event_id LIMIT 25""",
)
def l06_after(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return page_after(events, ["user_id", "event_id"], [20, 500], 25)


@query("l06_page_directory", "SELECT event_id, user_id, value FROM events ORDER BY user_id, event_id LIMIT 25 OFFSET 500")
def l06_directory(spark, sf_dir):
    """A page from a table that was sorted for paging once."""
    path = fresh_dir(spark, "pages")
    write_pages(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), ["user_id", "event_id"], path)
    return read_page(spark, path, 21, 25)
