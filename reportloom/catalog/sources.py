"""Scans, sources and sinks. Files are derived from the tables and written to a fresh shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.parsing import feed_time_rejects
from ..operators.aggregates import freq, monthly_summary, yearly_summary
from ..operators.cleaning import CLEAN_NAMES, FRENCH_COLUMNS, rename_map
from ..operators.joins import left_dim, literal_dim
from ..operators.retrieval import index_documents
from ..plans.feed_digest import feed_items
from ..plans.refinery import with_label
from ..sources.delimited import RAW_SCHEMA, latest_label, newest_drop, newest_file, read_delimited, read_parts, read_status
from ..sources.documents import read_documents, with_sizes, write_documents
from ..sources.feeds import read_feed
from ..sources.outputs import export_parts, export_single, write_feed, write_labelled, write_output, write_vectors
from ..sources.tables import complaints, table
from ..workspace import fresh_dir
from .registry import MONTHLY, over, query


def raw_reports(reports: DataFrame) -> DataFrame:
    """The report table as the publisher's bilingual all-string file."""
    texts = {
        "id": F.col("id").cast("string"),
        "date": F.date_format("date", "yyyy-MM-dd"),
        "num_victims": F.col("num_victims").cast("string"),
        "dollar_loss": F.concat(F.lit("$"), F.format_number("dollar_loss", 2)),
    }
    missing = [c for c in CLEAN_NAMES.values() if c not in reports.columns]
    full = reports.withColumns({c: F.lit(None).cast("string") for c in missing} | texts)
    named = [F.col(clean).alias(raw) for raw, clean in CLEAN_NAMES.items()]
    french = [F.lit(None).cast("string").alias(c) for c in FRENCH_COLUMNS]
    return full.select(*named, *french)


def write_raw(reports: DataFrame, path: str) -> str:
    raw_reports(reports).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
    return path


def append_raw_file(reports: DataFrame, folder: str) -> str:
    """One more raw file in the folder, as a publisher adds one per quarter.

    The texts are made in parallel and stored column by column, so that the task that writes the file reads little.
    """
    spark, staged = reports.sparkSession, fresh_dir(reports.sparkSession, "raw-texts")
    raw = raw_reports(reports)
    raw.write.option("compression", "zstd").parquet(staged)
    texts = spark.read.schema(raw.schema).parquet(staged)
    texts.coalesce(1).write.mode("append").option("header", True).option("sep", "\t").csv(folder)
    return folder


def dated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items from the web pages, one day apart in page order."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("page_id").cast("int"))
    return feed_items(table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("day", day)


def feed_rows(items: DataFrame, *more: str) -> DataFrame:
    published = F.date_format(F.col("day").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss Z")
    return items.select("title", "link", "description", published.alias("pubDate"), *more)


def write_feed_file(items: DataFrame, path: str) -> str:
    writer = feed_rows(items).write.mode("overwrite").format("xml")
    writer.option("rootTag", "channel").option("rowTag", "item").save(path)
    return path


@query(
    "s01_read_delimited",
    over(
        """SELECT CAST(id AS VARCHAR) AS id, strftime(date, '%Y-%m-%d') AS date, fraud_cat, age_range,
                  CAST(num_victims AS VARCHAR) AS num_victims,
                  '$' || format('{:,.2f}', CAST(dollar_loss AS DOUBLE)) AS dollar_loss FROM complaints_v"""
    ),
)
def s01(spark, sf_dir):
    path = write_raw(complaints(spark, sf_dir), fresh_dir(spark, "raw"))
    clean = rename_map(read_delimited(spark, path, schema=RAW_SCHEMA), CLEAN_NAMES)
    return clean.select("id", "date", "fraud_cat", "age_range", "num_victims", "dollar_loss")


@query(
    "s02_newest_drop",
    over(
        """SELECT 'drop_2' AS drop_name, count(*) AS records, strftime(min(date), '%Y-%m-%d') AS first_day,
                  strftime(max(date), '%Y-%m-%d') AS last_day FROM complaints_v"""
    ),
)
def s02(spark, sf_dir):
    reports, folder = complaints(spark, sf_dir), fresh_dir(spark, "drops")
    write_raw(reports.filter("gender <> 'P'"), f"{folder}/drop_1")
    write_raw(reports, f"{folder}/drop_2")
    newest = newest_drop(spark, folder)
    rows = rename_map(read_delimited(spark, newest, schema=RAW_SCHEMA), CLEAN_NAMES)
    return rows.agg(
        F.lit(newest.rsplit("/", 1)[-1]).alias("drop_name"),
        F.count("*").alias("records"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
    )


@query(
    "s02_newest_file",
    over(
        """SELECT count(*) AS records, strftime(min(date), '%Y-%m-%d') AS first_day, strftime(max(date), '%Y-%m-%d') AS last_day
           FROM complaints_v"""
    ),
)
def s02_file(spark, sf_dir):
    """Two files of one folder, the second written later."""
    reports, folder = complaints(spark, sf_dir), fresh_dir(spark, "files")
    append_raw_file(reports.filter("gender <> 'P'"), folder)
    append_raw_file(reports, folder)
    rows = rename_map(read_delimited(spark, newest_file(spark, folder, "*.csv"), schema=RAW_SCHEMA), CLEAN_NAMES)
    return rows.agg(F.count("*").alias("records"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query(
    "s03_read_parts",
    over(
        """SELECT year, month, CAST(total_loss AS DOUBLE) AS total_loss, total_victims FROM monthly_v
           UNION ALL
           SELECT year, NULL, CAST(sum(total_loss) AS DOUBLE), CAST(sum(total_victims) AS BIGINT) FROM monthly_v GROUP BY year""",
        MONTHLY,
    ),
)
def s03(spark, sf_dir):
    reports, base = complaints(spark, sf_dir, "date", "dollar_loss", "num_victims"), fresh_dir(spark, "parts")
    monthly = write_output(monthly_summary(reports), base, "all", "monthly")
    yearly = write_output(yearly_summary(reports), base, "all", "yearly")
    return read_parts(spark, monthly, yearly).withColumn("total_victims", F.col("total_victims").cast("bigint"))


@query(
    "s03_mixed_headers",
    over(
        """SELECT id, fraud_cat, CAST(num_victims AS VARCHAR) AS num_victims FROM complaints_v WHERE id % 2 = 0
           UNION ALL SELECT id, fraud_cat, NULL FROM complaints_v WHERE id % 2 = 1"""
    ),
)
def s03_mixed(spark, sf_dir):
    """One folder, two headers: the columns in another order, and one of them missing."""
    reports, path = complaints(spark, sf_dir, "id", "fraud_cat", "num_victims"), fresh_dir(spark, "mixed")
    reports.filter("id % 2 = 0").write.option("header", True).csv(path)
    reports.filter("id % 2 = 1").select("fraud_cat", "id").write.mode("append").option("header", True).csv(path)
    return read_parts(spark, path, schema="id bigint, num_victims string, fraud_cat string")


@query(
    "s04_latest_label",
    over(
        "SELECT id, date, label FROM labelled WHERE label = (SELECT max(label) FROM labelled)",
        "labelled AS (SELECT id, date, year(date) || '_Q' || quarter(date) AS label FROM complaints_v)",
    ),
)
def s04(spark, sf_dir):
    labelled = with_label(complaints(spark, sf_dir, "id", "date"))
    path = write_labelled(labelled, fresh_dir(spark, "labelled"))
    return latest_label(spark.read.schema(labelled.schema).parquet(path))


@query(
    "s05_write_output",
    over("SELECT year, month, CAST(total_loss AS DOUBLE) AS total_loss, total_victims FROM monthly_v", MONTHLY),
)
def s05(spark, sf_dir):
    reports = complaints(spark, sf_dir, "date", "dollar_loss", "num_victims")
    path = write_output(monthly_summary(reports).orderBy("year", "month"), fresh_dir(spark, "out"), "all", "monthly_summary")
    return read_parts(spark, path, schema="year int, month int, total_loss double, total_victims bigint")


@query("s06_export_parts", over("SELECT id, fraud_cat, CAST(dollar_loss AS DOUBLE) AS dollar_loss FROM complaints_v"))
def s06_parts(spark, sf_dir):
    path = export_parts(complaints(spark, sf_dir, "id", "fraud_cat", "dollar_loss"), fresh_dir(spark, "export"))
    return read_parts(spark, path, schema="id bigint, fraud_cat string, dollar_loss double", one_header=True)


@query(
    "s06_export_single",
    over("SELECT year, month, CAST(total_loss AS DOUBLE) AS total_loss, total_victims, CAST(1 AS BIGINT) AS files FROM monthly_v", MONTHLY),
)
def s06(spark, sf_dir):
    """A summary as one file."""
    monthly = monthly_summary(complaints(spark, sf_dir, "date", "dollar_loss", "num_victims"))
    path = export_single(monthly, fresh_dir(spark, "export"), "year", "month")
    rows = read_parts(spark, path, schema="year int, month int, total_loss double, total_victims bigint", one_header=True)
    files = spark.read.text(path).select(F.countDistinct("_metadata.file_path")).scalar()
    return rows.withColumn("files", files)


ITEMS_SQL = """items_v AS (
  SELECT page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS item_title, url AS item_link,
         CAST(DATE '2024-01-01' + CAST(page_id AS INTEGER) AS DATE) AS item_day,
         trim(regexp_replace(regexp_replace(html, '(?s)<(script|style)>.*?</(script|style)>|<[^>]+>', ' ', 'g'),
                             '\\s+', ' ', 'g')) AS item_description FROM pages)"""


@query("s07_read_feed", f"WITH {ITEMS_SQL} SELECT item_title, item_link, item_day, item_description FROM items_v")
def s07(spark, sf_dir):
    path = write_feed_file(dated_items(spark, sf_dir), fresh_dir(spark, "feed"))
    items = read_feed(spark, path, channel_date=False)
    return items.select(
        F.trim("item_title").alias("item_title"),
        "item_link",
        F.to_date("item_pub_date").alias("item_day"),
        "item_description",
    )


FEED_ITEMS = 50  # items per feed file


def write_dated_feeds(items: DataFrame, path: str) -> str:
    """Feed files of FEED_ITEMS items, each with the date of its channel: the last item's day at noon."""
    text = lambda c: F.replace(F.replace(F.replace(F.trim(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    stamp = lambda c, time: F.concat(F.date_format(c, "EEE, dd MMM yyyy"), F.lit(f" {time} +0000"))
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    fields = [("title", text("title")), ("link", text("link")), ("description", text("description")), ("pubDate", stamp("day", "00:00:00"))]
    item = tag("item", F.concat(*[tag(name, value) for name, value in fields]))
    feeds = items.groupBy(F.floor(F.col("page_id") / FEED_ITEMS).alias("feed")).agg(
        F.max("day").alias("day"), F.array_join(F.sort_array(F.collect_list(item)), "").alias("items")
    )
    channel = tag("channel", F.concat(tag("title", F.lit("Feed")), tag("pubDate", stamp("day", "12:00:00")), F.col("items")))
    rss = F.concat(F.lit("<rss version='2.0'>"), channel, F.lit("</rss>"))
    feeds.select("feed", rss.alias("value")).write.partitionBy("feed").text(path)
    return path


@query(
    "s07_feed_dates",
    f"""WITH {ITEMS_SQL}
        SELECT item_title, item_link, item_day, max(item_day) OVER (PARTITION BY page_id // 50) AS feed_day FROM items_v""",
)
def s07_dates(spark, sf_dir):
    """Items with the date of their channel beside their own."""
    items = read_feed(spark, write_dated_feeds(dated_items(spark, sf_dir), fresh_dir(spark, "feeds")))
    return items.select(
        F.trim("item_title").alias("item_title"),
        "item_link",
        F.to_date("item_pub_date").alias("item_day"),
        F.to_date("feed_pub_date").alias("feed_day"),
    )


# Ways to write the same day at noon, UTC.
DATE_FORMS = [
    ("EEE, dd MMM yyyy", " 12:00:00 +0000"), ("d MMM yy", " 12:00 GMT"), ("EEEE, d MMMM yyyy", " 12:00:00 UT"), ("EEE, dd MMM yyyy", " 07:00:00 EST"),
    ("dd MMM yyyy", " 05:00 PDT"), ("EEE, dd MMM yyyy", " 14:00:00 +02:00"), ("dd-MMM-yyyy", " 12:00:00 Z (noon)"), ("EEE, dd MMM yyyy", " 12:00:00"),
]


@query(
    "s07_feed_date_forms",
    """SELECT url AS item_link, CASE WHEN page_id % 8 < 7 THEN CAST(DATE '2024-01-01' + CAST(page_id AS INTEGER) AS VARCHAR) || ' 12:00:00' END AS item_time,
              count(*) FILTER (page_id % 8 = 7) OVER () AS unread FROM pages""",
)
def s07_forms(spark, sf_dir):
    """Dates in all forms that the standard allows; those without a zone are null and counted."""
    items = dated_items(spark, sf_dir)
    written = F.element_at(
        F.array(*[F.concat(F.date_format("day", pattern), F.lit(rest)) for pattern, rest in DATE_FORMS]), (F.col("page_id") % 8 + 1).cast("int")
    )
    folder = fresh_dir(spark, "forms")
    items.select("title", "link", "description", written.alias("pubDate")).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(folder)
    raw = spark.read.format("xml").option("rowTag", "item").schema("pubDate string").load(folder)
    unread = raw.agg(feed_time_rejects("pubDate")).scalar()
    time = F.date_format("item_pub_date", "yyyy-MM-dd HH:mm:ss").alias("item_time")
    return read_feed(spark, folder, channel_date=False).select("item_link", time, unread.alias("unread"))


@query(
    "s08_read_status",
    """SELECT count(*) AS records, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS INTEGER) AS flag,
              CASE WHEN count(*) = 0 THEN 'No records' ELSE 'Records Retrieved: ' || count(*) END AS message FROM pages""",
)
def s08(spark, sf_dir):
    path = write_feed_file(dated_items(spark, sf_dir), fresh_dir(spark, "feed"))
    return read_status(read_feed(spark, path, channel_date=False))


@query(
    "s09_read_documents",
    """SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS chars,
              CAST(CASE WHEN trim(text) = '' THEN 0
                   ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END AS INTEGER) AS words
       FROM documents""",
)
def s09(spark, sf_dir):
    """Documents as text files, one each, named by their id and filed by language; the reader finds them again."""
    folder = write_documents(table(spark, sf_dir, "documents"), fresh_dir(spark, "documents"), "lang", "doc_id", "text")
    found = read_documents(spark, folder).select(
        F.regexp_extract("path", r"/doc_id=(\d+)[/.]", 1).cast("bigint").alias("doc_id"),
        F.regexp_extract("path", r"/lang=([^/]*)/", 1).alias("lang"),
        F.regexp_replace("text", r"\n\z", "").alias("text"),  # the line end that the text writer adds
    )
    return with_sizes(found).drop("text")


CHUNKS_SQL = """words_v AS (
  SELECT doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS w FROM documents WHERE trim(text) <> ''),
chunks_v AS (
  SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, w[i * 180 + 1 : i * 180 + 200] AS cw
  FROM (SELECT doc_id, w, unnest(range(CAST(greatest(ceil((len(w) - 20) / 180.0), 1) AS BIGINT))) AS i FROM words_v))"""


@query(
    "s10_write_vectors",
    f"""WITH {CHUNKS_SQL}
        SELECT doc_id, count(*) AS chunks, CAST(sum(len(cw)) AS DOUBLE) AS words FROM chunks_v GROUP BY doc_id""",
)
def s10(spark, sf_dir):
    index = index_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    stored = spark.read.parquet(write_vectors(index, fresh_dir(spark, "vectors")))
    words = F.aggregate("embedding", F.lit(0.0), lambda total, v: total + v)
    return stored.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum(words).alias("words"))


URGENCY = (("1-URGENT", "now"), ("2-HIGH", "soon"), ("3-MEDIUM", "soon"), ("5-LOW", "later"))


@query(
    "s11_literal_dim",
    over(
        """SELECT fraud_cat, count(*) AS n, urgency FROM complaints_v LEFT JOIN (VALUES ('1-URGENT', 'now'),
                  ('2-HIGH', 'soon'), ('3-MEDIUM', 'soon'), ('5-LOW', 'later')) d(cat, urgency) ON fraud_cat = cat
           WHERE fraud_cat IS NOT NULL GROUP BY ALL"""
    ),
)
def s11(spark, sf_dir):
    dim = literal_dim(spark, URGENCY, "fraud_cat string, urgency string")
    return left_dim(freq(complaints(spark, sf_dir, "fraud_cat"), "fraud_cat"), dim, "fraud_cat")


def published_items(spark, sf_dir, newest: int | None) -> DataFrame:
    path = fresh_dir(spark, "published")
    write_feed(feed_rows(dated_items(spark, sf_dir), "day"), path, "day", "link", newest=newest)
    published = read_feed(spark, path, channel_date=False)
    return published.select(
        F.trim("item_title").alias("item_title"), "item_link", F.to_date("item_pub_date").alias("item_day")
    )


@query("s12_write_feed", f"WITH {ITEMS_SQL} SELECT item_title, item_link, item_day FROM items_v")
def s12(spark, sf_dir):
    return published_items(spark, sf_dir, None)


@query(
    "s12_write_feed_newest",
    f"WITH {ITEMS_SQL} SELECT item_title, item_link, item_day FROM items_v ORDER BY item_day DESC, item_link LIMIT 20",
)
def s12_newest(spark, sf_dir):
    """A feed of a stated length: the newest 20 items."""
    return published_items(spark, sf_dir, 20)
