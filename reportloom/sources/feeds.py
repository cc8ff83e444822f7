"""Feed files in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.parsing import to_feed_time

ITEM_SCHEMA = "title string, link string, description string, pubDate string"


def as_items(rows: DataFrame) -> DataFrame:
    """Parsed `item` elements as the item table; a broken file's empty row goes, as does an item without a link."""
    return rows.filter(F.trim("link") != "").select(
        F.col("title").alias("item_title"),
        F.trim("link").alias("item_link"),
        F.col("description").alias("item_description"),
        to_feed_time("pubDate").alias("item_pub_date"),
        F.col("_metadata.file_path").alias("feed"),
    )


def read_feed(spark: SparkSession, path: str, channel_date: bool = True) -> DataFrame:
    """Items of every feed file under `path`, with the date of their channel and their own date.

    An unreadable feed gives no rows instead of a failure.
    """
    xml = spark.read.format("xml").option("mode", "PERMISSIVE")
    items = as_items(xml.option("rowTag", "item").schema(ITEM_SCHEMA).load(path))
    if not channel_date:
        return items
    return items.join(channel_dates(spark, path), "feed", "left")


def channel_dates(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(feed, feed_pub_date): the date of the channel in each feed file; the latest, should a file hold several."""
    channels = spark.read.format("xml").option("mode", "PERMISSIVE").option("rowTag", "channel").schema("pubDate string").load(path)
    dated = channels.select(F.col("_metadata.file_path").alias("feed"), to_feed_time("pubDate").alias("feed_pub_date"))
    return dated.groupBy("feed").agg(F.max("feed_pub_date").alias("feed_pub_date"))
