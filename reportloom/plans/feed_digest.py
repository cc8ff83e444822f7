"""Feed files -> searchable, paged table of linked titles, newest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.links import link_html
from ..operators.filters import search_predicate


def digest(items: DataFrame, query: str | None = None) -> DataFrame:
    """Linked title, dates and description; `query` is a case-insensitive regex on any text.

    Sorted by the date of the channel, where it was read, then by the item's own date, newest first.
    """
    if query is not None:
        items = items.filter(search_predicate("item_title", query) | search_predicate("item_description", query))
    dates = [name for name in ("feed_pub_date", "item_pub_date") if name in items.columns]
    rows = items.select(link_html("item_title", "item_link").alias("item"), *dates, "item_link", "item_description")
    newest = [F.col(name).desc_nulls_last() for name in dates]
    return rows.orderBy(*newest, "item_link").drop("item_link")


def digest_page(items: DataFrame, query: str | None, number: int, size: int = 10) -> DataFrame:
    return digest(items, query).offset((number - 1) * size).limit(size)


def feed_items(pages: DataFrame, *more: str) -> DataFrame:
    """Web pages as feed items: title and body text taken from the markup."""
    body = F.trim(F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)>.*?</(script|style)>|<[^>]+>", " "), r"\s+", " "))
    return pages.select(
        "page_id", page_title("html").alias("title"), F.col("url").alias("link"), body.alias("description"), *more
    )


def page_title(html: str):
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)
