from __future__ import annotations

import datetime as dt
import gzip
import json
import time
from types import SimpleNamespace

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from reportloom import workspace
from reportloom.catalog import sources
from reportloom.catalog.sources import append_raw_file, raw_reports, write_raw
from reportloom.operators.cleaning import CLEAN_NAMES, FRENCH_COLUMNS
from reportloom.plans.feed_digest import digest
from reportloom.plans.refinery import refine, with_label
from reportloom.plans.site_search import read_search_docs, search_site
from reportloom.sources import delimited, documents, feeds, outputs
from reportloom.sources.tables import complaints
from reportloom.streaming import feed_history, refresh
from reportloom.streaming.feed_history import ingest_feed, read_history
from reportloom.streaming.refresh import published_drops, read_clean, read_monthly, refresh_summaries

ITEM = "<item><title>{t}</title><link>{l}</link><description>d {t}</description>{d}</item>"
DATE = "<pubDate>Mon, 01 Sep 2025 00:00:00 -0400</pubDate>"


def feed(*links, dated=True):
    items = "".join(ITEM.format(t=f"T&amp;{n}", l=f"http://x/{n}", d=DATE if dated else "") for n in links)
    return f"<rss version='2.0'><channel><title>F</title><pubDate>Tue, 02 Sep 2025 00:00:00 +0000</pubDate>{items}</channel></rss>"


def test_raw_file_round_trip(spark, tmp_path):
    header = [*CLEAN_NAMES, *FRENCH_COLUMNS]
    line = ["1", "2025-01-02", "t", "Canada", "Ontario", "c", "m", "F", "English", "'10 - 19", "s", "2", "$1,000.50"] + ["f"] * 8
    (tmp_path / "a.tsv").write_text("\t".join(header) + "\n" + "\t".join(line) + "\n")
    row = delimited.read_delimited(spark, str(tmp_path / "a.tsv"))
    assert row.columns == header and row.first()["Dollar Loss /pertes financieres"] == "$1,000.50"
    (tmp_path / "b.tsv").write_text("\t".join(header[:-2]) + "\n" + "\t".join(line[:-2]) + "\n")
    assert len(delimited.read_delimited(spark, str(tmp_path / "b.tsv")).columns) == 19


def test_differing_headers_are_an_error(spark, tmp_path):
    (tmp_path / "1.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "2.tsv").write_text("b\ta\n1\t2\n")
    with pytest.raises(Exception, match="header"):
        delimited.read_delimited(spark, str(tmp_path)).collect()


def test_refresh_reads_columns_by_name(spark, tmp_path):
    raw = raw_reports(reports(spark, report(dt.date(2025, 2, 1), 3, 1)))
    turned = raw.select(*reversed(raw.columns))
    turned.write.option("header", True).option("sep", "\t").csv(str(tmp_path / "in" / "a"))
    run = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    refresh_summaries(spark, *run)
    row = read_monthly(spark, run[1]).first()
    assert (row.label, row.total_victims, float(row.total_loss)) == ("2025_Q1", 3, 10.0)


def test_newest_file(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "old.tsv").write_text("a")
    time.sleep(0.05)
    (tmp_path / "new.tsv").write_text("b")
    (tmp_path / "later.txt").write_text("c")
    assert delimited.newest_file(spark, str(tmp_path)).endswith("/new.tsv")
    with pytest.raises(FileNotFoundError):
        delimited.newest_file(spark, str(tmp_path), "*.csv")


def test_parts_are_stacked_by_name(spark, tmp_path):
    for name, text in (("p", "a,b\n1,x\n"), ("q", "b,a\ny,2\n"), ("r", "a\n3\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(text)
    got = delimited.read_parts(spark, *[str(tmp_path / n) for n in "pqr"])
    assert sorted(tuple(r) for r in got.select("a", "b").collect()) == [(1, "x"), (2, "y"), (3, None)]


@pytest.mark.parametrize("schema", [None, "year int, month int, total int"])
def test_files_of_one_folder_may_differ(spark, tmp_path, schema):
    (tmp_path / "1.csv").write_text("year,month,total\n2025,2,7\n")
    (tmp_path / "2.csv").write_text("month,year,total\n3,2024,8\n")
    (tmp_path / "3.csv").write_text("total,year\n9,2023\n")
    got = delimited.read_parts(spark, str(tmp_path), schema=schema).select("year", "month", "total").collect()
    assert sorted(map(tuple, got)) == [(2023, None, 9), (2024, 3, 8), (2025, 2, 7)]


def test_latest_label_reads_one_partition(spark, sf_dir, tmp_path):
    path = outputs.write_labelled(with_label(complaints(spark, sf_dir, "id", "date")), str(tmp_path / "t"))
    latest = delimited.latest_label(spark.read.parquet(path))
    assert {r.label for r in latest.collect()} == {"2001_Q3"}
    plan = final_plan(latest)
    assert "PartitionFilters: [isnotnull(label" in plan and "subquery" not in plan.lower()
    odd = spark.createDataFrame([("a b:1", 1), ("a b:2", 2), (None, 3)], "label string, v int")
    odd.write.partitionBy("label").parquet(str(tmp_path / "folder of files"))
    assert [r.v for r in delimited.latest_label(spark.read.parquet(str(tmp_path / "folder of files"))).collect()] == [2]
    odd.withColumn("k", F.lit(1)).write.partitionBy("k", "label").parquet(str(tmp_path / "second"))
    assert [r.v for r in delimited.latest_label(spark.read.parquet(str(tmp_path / "second"))).collect()] == [2]
    plain = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "label string, v int")
    assert sorted(r.v for r in delimited.latest_label(plain).collect()) == [2, 3]


def test_exports(spark, tmp_path):
    df = spark.range(25).repartition(3)
    outputs.export_single(df, str(tmp_path / "one"), "id")
    (whole,) = (tmp_path / "one").glob("*.csv")
    assert whole.read_text().split() == ["id", *map(str, range(25))]
    outputs.export_parts(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("*.csv"))) == 3
    assert delimited.read_parts(spark, str(tmp_path / "many")).count() == 25


def test_read_status(spark):
    assert tuple(delimited.read_status(spark.range(0)).first()) == (0, 1, "No records")
    assert tuple(delimited.read_status(spark.range(3)).first()) == (3, 0, "Records Retrieved: 3")


def test_documents_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one two\nthree")
    (tmp_path / "sub" / "b.txt").write_text("  ")
    docs = documents.with_sizes(documents.read_documents(spark, str(tmp_path)))
    assert sorted((r.path.rsplit("/", 1)[1], r.chars, r.words) for r in docs.collect()) == [("a.txt", 13, 3), ("b.txt", 2, 0)]


def test_documents_take_no_folder_and_no_task_each(spark, tmp_path, monkeypatch):
    langs = ("en", "de", None)
    rows = [(i, langs[i % 3], f"word {i}\nlast ") for i in range(2500)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    folder = tmp_path / "folder"
    monkeypatch.setattr(sources, "fresh_dir", lambda _, name: str(folder))
    monkeypatch.setattr(documents, "READERS", 20)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        found = sources.s09(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
        got = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, lang or "__HIVE_DEFAULT_PARTITION__", len(text), 3) for i, lang, text in rows]
    files = [f for f in folder.rglob("doc_id=*") if f.is_file()]
    assert {f.name for f in files} == {f"doc_id={i}.txt" for i in range(2500)}
    assert (folder / "lang=de").is_dir() and files[0].read_bytes().startswith(b"word ")
    assert len({f.parent for f in files}) == 3
    monkeypatch.setattr(documents, "SHELF", 100)
    shelved = documents.write_documents(spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path / "shelved"), "lang", "doc_id", "text")
    assert len({f.parent for f in (tmp_path / "shelved").rglob("doc_id=*.txt")}) == 27
    assert documents.read_documents(spark, shelved).select("text").distinct().count() == 2500


def test_documents_elsewhere_are_written_by_spark(spark, tmp_path):
    odd = ["en", None, "", "a b", "x/y=%", "q'\"#?*:", "[^]{}", "back\\slash", "t\tab", "é"]
    rows = [(i, lang, text) for i, (lang, text) in enumerate((a, b) for a in odd for b in ("one two", "", None, "l\n", "ü\r\n ")) for _ in range(1 + i % 2)]
    docs = spark.createDataFrame(rows, "id long, lang string, text string").coalesce(1)
    spark.conf.set("fs.viewfs.mounttable.store.link./out", f"file://{tmp_path}")
    try:
        found = []
        for base in (f"{tmp_path}/a b%", "viewfs://store/out/far"):
            read = documents.read_documents(spark, documents.write_documents(docs, base, "lang", "id", "text"))
            place = [F.regexp_extract("path", r"/lang=([^/]*)/", 1), F.regexp_extract("path", r"/id=(\d+)[/.]", 1).cast("int")]
            found.append(sorted(map(tuple, read.select(*place, "text").collect())))
    finally:
        spark.conf.unset("fs.viewfs.mounttable.store.link./out")
    assert found[0] == found[1] and len(found[0]) == 50
    assert not list((tmp_path / "far").rglob("shelf=*")) and list((tmp_path / "a b%").rglob("shelf=*"))
    none = documents.write_documents(docs.where("id < 0"), str(tmp_path / "none"), "lang", "id", "text")
    assert documents.read_documents(spark, none).collect() == []


def test_names_of_documents_stay_off_the_driver(spark, tmp_path, monkeypatch):
    """Tasks list a mounted folder and find the files that Spark's reader finds, under the same paths."""
    root = tmp_path / "a b%#ü"
    names = ["a.txt", "b c.txt", "_hidden.txt", "_k=v.txt", ".dot.txt", "c._COPYING_", "d%41[x]^`|.txt", "q'\"?#.md", "x\u3000y\u200b\U0001f600", "new\nline", "empty"]
    for sub in ("", "sub/deep", "_hidden", "_p=1", "x=1/y=2", ".git"):
        (root / sub).mkdir(parents=True, exist_ok=True)
        for name in names:
            (root / sub / name).write_bytes(b"" if name == "empty" else f"{sub} {name}\r\n".encode() + b"\xff\x00")
    (root / "nowhere").symlink_to(root / "gone")
    (root / "again").symlink_to(root / "sub")
    monkeypatch.setattr(documents, "BATCH_BYTES", 64, raising=False)

    def rows(df):
        return sorted((r.path, bytes(r.text)) for r in df.withColumn("text", F.col("text").cast("binary")).collect())

    for glob, n in (("*", 35), ("*.txt", 20), ("[!a]*.{txt,md}", 20)):
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(str(root), wholetext=True)
        found = documents.read_documents(spark, str(root), glob)
        assert found.inputFiles() and all("/listing-" in name for name in found.inputFiles())
        assert rows(found) == rows(reader.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))) and found.count() == n
    (root / "z.txt.gz").write_bytes(gzip.compress(b"packed"))
    assert [r.text for r in documents.read_documents(spark, str(root), "z*").collect()] == ["packed"]
    assert documents.read_documents(spark, str(root / ".git"), "no*").collect() == []
    assert documents.read_documents(spark, f"{root}/sub/de*", "a.txt").count() == documents.read_documents(spark, str(root / "a.txt")).count() == 1


def test_a_task_that_runs_again_leaves_the_same_files(spark, tmp_path, monkeypatch):
    (tmp_path / "to").mkdir()
    monkeypatch.setattr(documents.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 3))
    rows = [SimpleNamespace(by="en", id=i, value=b"text %d" % i) for i in range(5)]
    write = documents._files(str(tmp_path / "to"), "lang", "id")

    def cut():
        yield from rows[:3]
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        write(cut())
    write(iter(rows))
    assert {f.name: f.read_bytes() for f in (tmp_path / "to").rglob("id=*")} == {f"id={i}.txt": b"text %d\n" % i for i in range(5)}
    assert all(f.parent.name == "shelf=00003-00000" for f in (tmp_path / "to").rglob("id=*"))
    with pytest.raises(FileNotFoundError, match="not mounted"):
        documents._files(str(tmp_path / "away"), "lang", "id")(iter(rows))


def test_feeds(spark, tmp_path):
    (tmp_path / "ok.xml").write_text(feed(1, 2) .replace(DATE, "", 1))
    (tmp_path / "bad.xml").write_text("<rss><channel><item><title>cut")
    items = feeds.read_feed(spark, str(tmp_path)).orderBy("item_link").collect()
    assert [(r.item_title, r.item_link) for r in items] == [("T&1", "http://x/1"), ("T&2", "http://x/2")]
    assert items[0].item_pub_date is None and items[1].item_pub_date is not None
    assert {r.feed_pub_date.date() for r in items} == {dt.date(2025, 9, 2)}
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "bad.xml").write_text("<rss><channel><item><title>cut")
    empty = feeds.read_feed(spark, str(tmp_path / "only"))
    assert delimited.read_status(empty).first().flag == 1
    rows = digest(feeds.read_feed(spark, str(tmp_path)), "t&2").collect()
    assert [r.item for r in rows] == [
        "<a target='_blank' title='T&amp;2' href='http://x/2' rel='noopener'>T&amp;2</a>"
    ]


def test_site_search_over_json(spark, tmp_path):
    docs = [
        {"title": "Loss report", "section": "", "text": "a loss", "href": "p.html", "crumbs": ["Home"]},
        {"title": "x", "section": "Losses", "text": "no hit", "href": "p.html#s?x"},
        {"title": "x", "section": "x", "text": "x", "href": "q.html"},
    ]
    (tmp_path / "search.json").write_text(json.dumps(docs))
    found = search_site(read_search_docs(spark, str(tmp_path / "search.json")), "loss").orderBy("position").collect()
    assert [(r.link, r.row_type, r.score, r.hits) for r in found] == [
        ("p.html?q=loss", "document", 30, 2),
        ("p.html?q=loss#s?x", "item", 20, 2),
    ]
    assert found[0].snippet == "a <mark class='search-match'>loss</mark>" and found[0].crumbs == ["Home"]
    (tmp_path / "search.jsonl").write_text("\n".join(map(json.dumps, docs)))
    assert read_search_docs(spark, str(tmp_path / "search.jsonl")).count() == 3


def test_published_feed(spark, tmp_path):
    rows = [(f"t{i}", f"l{i}", i) for i in range(30)]
    items = spark.createDataFrame(rows, "title string, link string, n int").repartition(3)
    outputs.write_feed(items, str(tmp_path / "f"), "n", "link", newest=20)
    got = feeds.read_feed(spark, str(tmp_path / "f"), channel_date=False)
    assert [r.item_link for r in got.collect()] == [f"l{i}" for i in range(29, 9, -1)]
    outputs.write_feed(items, str(tmp_path / "all"), "n", "link", newest=None)
    assert feeds.read_feed(spark, str(tmp_path / "all"), channel_date=False).count() == 30
    with pytest.raises(TypeError):
        outputs.write_feed(items, str(tmp_path / "x"), "n", "link")


def test_feed_history_takes_unseen_links_only(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = (str(src), str(tmp_path / "history"), str(tmp_path / "checkpoint"))
    (src / "feed_1.xml").write_text(feed(1, 2, 3, 3, 3))
    ingest_feed(spark, *run)
    assert read_history(spark, run[1]).count() == 3
    ingest_feed(spark, *run)
    (src / "feed_2.xml").write_text(feed(3, 4, dated=False))
    (src / "feed_3.xml").write_text("<rss><channel><item><title>cut")
    ingest_feed(spark, *run)
    history = read_history(spark, run[1])
    assert sorted(r.item_link for r in history.collect()) == [f"http://x/{n}" for n in (1, 2, 3, 4)]


def test_feed_history_survives_a_new_checkpoint(spark, tmp_path):
    src, history = tmp_path / "in", str(tmp_path / "history")
    src.mkdir()
    (src / "feed_1.xml").write_text(feed(1, 2))
    ingest_feed(spark, str(src), history, str(tmp_path / "checkpoint_1"))
    (src / "feed_1.xml").unlink()
    (src / "feed_2.xml").write_text(feed(2, 3))
    ingest_feed(spark, str(src), history, str(tmp_path / "checkpoint_2"))
    rows = read_history(spark, history).collect()
    assert sorted((r.item_link, r.batch) for r in rows) == [("http://x/1", 0), ("http://x/2", 0), ("http://x/3", 0)]
    assert len({r.stream for r in rows}) == 2


def test_a_run_reads_few_folders_of_the_history(spark, tmp_path):
    src, history = tmp_path / "in", str(tmp_path / "history")
    src.mkdir()
    (src / "feed_1.xml").write_text(feed(*range(200)))
    ingest_feed(spark, str(src), history, str(tmp_path / "checkpoint"))
    links = spark.createDataFrame([("http://x/7",), ("http://x/new",)], "item_link string")
    links = links.withColumn("bucket", F.pmod(F.xxhash64("item_link"), F.lit(feed_history.BUCKETS)).cast("int"))
    new = feed_history.unseen(links, read_history(spark, history), "other", 0)
    assert [r.item_link for r in new.collect()] == ["http://x/new"]
    assert "bucket#" in final_plan(new).split("PartitionFilters: [")[1].split("PushedFilters")[0]


def dated_feed(day, *links):
    items = "".join(f"<item><title>T</title><link>http://x/{n}</link><pubDate>0{n} Sep 2025 00:00 GMT</pubDate></item>" for n in links)
    return f"<rss><channel><title>c</title><pubDate>{day} Sep 2025 12:00:00 EST</pubDate>{items}</channel></rss>"


def test_history_keeps_item_and_channel_dates(spark, tmp_path):
    src = tmp_path / "feeds of a day"
    src.mkdir()
    run = (str(src), str(tmp_path / "history"), str(tmp_path / "checkpoint"))
    (src / "feed 1.xml").write_text(dated_feed(10, 1, 2))
    (src / "feed 2.xml").write_text("<rss><channel><item><link>http://x/9</link></item></channel></rss>")
    ingest_feed(spark, *run)
    (src / "feed 3.xml").write_text(dated_feed(11, 2, 3))
    ingest_feed(spark, *run)
    want = {1: (1, 10), 2: (2, 10), 3: (3, 11), 9: (None, None)}
    rows = {int(r.item_link[-1]): (r.item_pub_date and r.item_pub_date.day, r.feed_pub_date and r.feed_pub_date.day) for r in read_history(spark, run[1]).collect()}
    assert rows == want


def written_batches(spark, history, batches, links=30, stream="s"):
    """A history of many small batches, as that many runs would have left it."""
    rows = spark.range(batches * links).select(
        F.concat(F.lit("http://x/"), F.col("id")).alias("item_link"), (F.col("id") % batches).alias("batch"), F.lit(stream).alias("stream")
    )
    empty = spark.createDataFrame([], feed_history.HISTORY_SCHEMA)
    rows = empty.unionByName(rows.withColumn("bucket", feed_history._bucket("item_link", feed_history.BUCKETS)), allowMissingColumns=True)
    rows.repartition(4, "bucket").write.mode("append").partitionBy("bucket", "stream", "batch").parquet(history)


def files_of(history):
    return sorted(history.rglob("*.parquet"))


def test_compaction_of_a_hundred_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_history, "BUCKETS", 8)
    history, src = tmp_path / "history", tmp_path / "in"
    written_batches(spark, str(history), 100)
    want = sorted(r.item_link for r in read_history(spark, str(history)).collect())
    before = len(files_of(history))
    assert before > 700 and feed_history.compact_history(spark, str(history), least_batches=101) == 0
    assert feed_history.compact_history(spark, str(history)) == 100
    data = [f for f in files_of(history) if "_manifest" not in str(f)]
    assert len(data) <= 16 and all("stream=merged" in str(f) for f in data)
    assert sorted(r.item_link for r in read_history(spark, str(history)).collect()) == want
    # a run after it reads few files, adds only what is new, and a few links are looked up by value
    src.mkdir()
    (src / "feed.xml").write_text(feed(1, 2, 5000, 5001))
    ingest_feed(spark, str(src), str(history), str(tmp_path / "checkpoint"))
    assert sorted(r.item_link for r in read_history(spark, str(history)).collect()) == sorted([*want, "http://x/5000", "http://x/5001"])
    links = spark.createDataFrame([("http://x/7",), ("http://x/new",)], "item_link string")
    new = feed_history.unseen(links, read_history(spark, str(history)), "other", 0)
    plan = final_plan(new)
    assert [r.item_link for r in new.collect()] == ["http://x/new"] and "http://x/7" in plan.split("PushedFilters")[1]


def test_compaction_in_levels_with_more_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_history, "BUCKETS", 4)
    monkeypatch.setattr(feed_history, "BUCKET_ROWS", 20)
    monkeypatch.setattr(feed_history, "LEVELS", 2)
    history = str(tmp_path / "history")
    want = set()
    for turn in range(4):
        stream = f"s{turn}"
        written_batches(spark, history, 3 + turn, links=20, stream=stream)
        fresh = read_history(spark, history).filter(F.col("stream") == stream)
        want |= {r.item_link for r in fresh.collect()}
        feed_history.compact_history(spark, history, least_batches=1)
    state = feed_history._State(spark, history)
    assert state.buckets > 4 and len(state.live) <= 2
    assert {r.item_link for r in read_history(spark, history).collect()} == want
    asked = spark.createDataFrame([(f"http://x/{n}",) for n in (0, 5, 50, 119, 777)], "item_link string")
    new = feed_history.unseen(asked, read_history(spark, history), "other", 0, state.buckets)
    assert [r.item_link for r in new.collect()] == ["http://x/777"]


@pytest.mark.parametrize("step", ["publish", "_delete_batches"])
def test_a_crash_during_compaction_is_not_seen(spark, tmp_path, monkeypatch, step):
    monkeypatch.setattr(feed_history, "BUCKETS", 4)
    history = str(tmp_path / "history")
    written_batches(spark, history, 5)
    want = sorted(r.item_link for r in read_history(spark, history).collect())
    kept, calls = getattr(feed_history, step), []

    def crash(*args):
        if step == "_delete_batches" and not calls:  # the first call clears what an earlier crash has left
            calls.append(1)
            return kept(*args)
        raise OSError("lost")

    monkeypatch.setattr(feed_history, step, crash)
    with pytest.raises(OSError):
        feed_history.compact_history(spark, history, least_batches=1)
    monkeypatch.setattr(feed_history, step, kept)
    assert sorted(r.item_link for r in read_history(spark, history).collect()) == want
    assert feed_history.compact_history(spark, history, least_batches=1) == (5 if step == "publish" else 0)
    assert sorted(r.item_link for r in read_history(spark, history).collect()) == want
    assert not list((tmp_path / "history").rglob("stream=s/batch=*"))


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = (str(src), str(tmp_path / "history"), str(tmp_path / "checkpoint"))
    for n, links in enumerate([(1, 2), (2, 3)]):
        (src / f"feed_{n}.xml").write_text(feed(*links))
        ingest_feed(spark, *run)
    # As after a failure between writing the batch and committing it.
    (tmp_path / "checkpoint" / "commits" / "1").unlink()
    (tmp_path / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    ingest_feed(spark, *run)
    rows = sorted((r.item_link, r.batch) for r in read_history(spark, run[1]).collect())
    assert rows == [("http://x/1", 0), ("http://x/2", 0), ("http://x/3", 1)]


def report(day, victims, i, country="Canada"):
    return (i, day, country, "ON", "c", "m", "F", "'10 - 19", victims, 10.0)


def reports(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "id int, date date, country string, province string, fraud_cat string, sol_method string, gender string, "
        "age_range string, num_victims int, dollar_loss double",
    )


def test_refresh_replaces_whole_quarters(spark, tmp_path):
    q1, q2, q3 = dt.date(2025, 2, 1), dt.date(2025, 5, 1), dt.date(2025, 8, 1)
    run = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    write_raw(reports(spark, report(q1, 1, 1), report(q2, 1, 2), report(q2, 1, 3), report(None, 5, 9)), f"{run[0]}/2025_Q2")
    refresh_summaries(spark, *run)
    before = {r.label: r.total_victims for r in read_monthly(spark, run[1]).collect()}
    assert before == {"2025_Q1": 1, "2025_Q2": 2, "undated": 5}
    # Two drops at once: the later one states the third quarter again, and the second is corrected.
    write_raw(reports(spark, report(q3, 7, 4), report(q2, 4, 2)), f"{run[0]}/2025_Q3a")
    write_raw(reports(spark, report(q3, 8, 4), report(q3, 1, 5, "Not Specified")), f"{run[0]}/2025_Q3b")
    refresh_summaries(spark, *run)
    after = {r.label: r.total_victims for r in read_monthly(spark, run[1]).collect()}
    assert after == {"2025_Q1": 1, "2025_Q2": 4, "2025_Q3": 8, "undated": 5}
    assert sorted(r.id for r in read_clean(spark, run[1]).collect()) == ["1", "2", "4", "9"]


def test_an_older_drop_that_arrives_later_does_not_win(spark, tmp_path):
    q1, q2 = dt.date(2025, 2, 1), dt.date(2025, 5, 1)
    run = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    write_raw(reports(spark, report(q1, 5, 1), report(q2, 6, 2)), f"{run[0]}/drop_2")
    refresh_summaries(spark, *run)
    write_raw(reports(spark, report(q1, 1, 1), report(dt.date(2024, 2, 1), 3, 7)), f"{run[0]}/drop_1")
    refresh_summaries(spark, *run)
    assert {r.label: r.total_victims for r in read_monthly(spark, run[1]).collect()} == {"2024_Q1": 3, "2025_Q1": 5, "2025_Q2": 6}
    drops = {r.label: r["drop"] for r in published_drops(spark, run[1]).collect()}
    assert drops == {"2024_Q1": "drop_1", "2025_Q1": "drop_2", "2025_Q2": "drop_2"}


@pytest.mark.parametrize("step", ["monthly_summary", "publish"])
def test_a_crash_between_the_tables_is_not_seen(spark, tmp_path, monkeypatch, step):
    q1, q2 = dt.date(2025, 2, 1), dt.date(2025, 5, 1)
    run = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    write_raw(reports(spark, report(q1, 5, 1), report(q2, 6, 2)), f"{run[0]}/drop_1")
    refresh_summaries(spark, *run)

    def state():
        clean = sorted((r.id, r.num_victims) for r in read_clean(spark, run[1]).collect())
        return clean, {r.label: r.total_victims for r in read_monthly(spark, run[1]).collect()}

    before = state()
    assert before == ([("1", 5), ("2", 6)], {"2025_Q1": 5, "2025_Q2": 6})
    write_raw(reports(spark, report(q1, 7, 1), report(q1, 1, 3)), f"{run[0]}/drop_2")
    kept = getattr(refresh, step)

    def crash(*args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(refresh, step, crash)
    with pytest.raises(Exception, match="lost"):
        refresh_summaries(spark, *run)
    assert state() == before
    monkeypatch.setattr(refresh, step, kept)
    refresh_summaries(spark, *run)
    assert state() == ([("1", 7), ("2", 6), ("3", 1)], {"2025_Q1": 8, "2025_Q2": 6})
    refresh_summaries(spark, *run)  # the next run deletes what was replaced, not what counts
    assert state() == ([("1", 7), ("2", 6), ("3", 1)], {"2025_Q1": 8, "2025_Q2": 6})
    assert len(list((tmp_path / "out" / "clean" / "label=2025_Q1").glob("version=*"))) == 1


def test_refinery(spark, tmp_path):
    rows = reports(spark, report(dt.date(2025, 2, 1), 1, 1), report(dt.date(2025, 9, 1), 2, 2), report(dt.date(2025, 9, 2), 3, 3, None))
    assert raw_reports(rows).columns == [*CLEAN_NAMES, *FRENCH_COLUMNS]
    write_raw(rows, str(tmp_path / "drops" / "one"))
    folder = {"glob": "*.csv", "delivery": True}
    done = refine(spark, str(tmp_path / "drops"), str(tmp_path / "out"), **folder)
    assert done.label == "2025_Q3" and done.clean.count() == 2
    assert {(r.year, r.month): r.total_victims for r in done.monthly.collect()} == {(2025, 2): 1, (2025, 9): 2}
    assert float(done.yearly.first().total_loss) == 20.0
    for name in ("clean_reports", "monthly_summary", "yearly_summary"):
        assert list((tmp_path / "out" / "outputs_2025_Q3" / name).glob("*.csv"))
    write_raw(reports(spark, report(None, 1, 1)), str(tmp_path / "undated" / "one"))
    with pytest.raises(ValueError):
        refine(spark, str(tmp_path / "undated"), str(tmp_path / "none"), **folder)
    everyone = refine(spark, str(tmp_path / "drops"), str(tmp_path / "out"), country_sentinel=None, **folder)
    assert everyone.clean.count() == 3 and done.clean.count() == 2  # each run has its own staging


def test_refinery_reads_the_newest_file_only(spark, tmp_path):
    raw = raw_reports(reports(spark, report(dt.date(2025, 5, 1), 1, 1), report(dt.date(2025, 9, 1), 2, 2)))
    header = "\t".join(raw.columns)
    lines = ["\t".join("" if v is None else str(v) for v in row) for row in sorted(raw.collect(), key=lambda r: r[0])]
    (tmp_path / "2025_Q2.tsv").write_text(f"{header}\n{lines[0]}\n")
    time.sleep(0.05)
    (tmp_path / "2025_Q3.tsv").write_text(f"{header}\n{lines[0]}\n{lines[1]}\n")
    done = refine(spark, str(tmp_path), str(tmp_path / "out"))
    assert {(r.month, r.total_victims) for r in done.monthly.collect()} == {(5, 1), (9, 2)}


def session_with(settings, master):
    return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_comes_from_the_session():
    named = session_with({"spark.checkpoint.dir": "/shared/place/"}, "spark://x")
    assert workspace.fresh_dir(named, "x").startswith("/shared/place/x-")
    assert "reportloom-" in workspace.shared_base(session_with({}, "local[2]"))
    with pytest.raises(RuntimeError):
        workspace.shared_base(session_with({}, "spark://x"))


def test_money_text_of_the_raw_file(spark, sf_dir):
    raw = raw_reports(complaints(spark, sf_dir))
    assert raw.filter(F.col("Dollar Loss /pertes financieres").startswith("$")).count() > 0


def test_a_raw_file_is_written_without_a_shuffle_of_its_rows(spark, tmp_path, monkeypatch):
    rows = reports(spark, report(dt.date(2025, 5, 1), 1, 1), report(dt.date(2025, 9, 1), 2, 2)).repartition(2)
    monkeypatch.setattr(type(rows), "repartition", None)
    for n in (1, 2):
        append_raw_file(rows, str(tmp_path / "in"))
        assert len(list((tmp_path / "in").glob("*.csv"))) == n
    newest = delimited.read_delimited(spark, delimited.newest_file(spark, str(tmp_path / "in"), "*.csv"))
    assert sorted(map(tuple, newest.collect()), key=str) == sorted(map(tuple, raw_reports(rows).collect()), key=str)
