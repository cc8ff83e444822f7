"""Feed history that grows by unseen links only."""

from __future__ import annotations

from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.feeds import ITEM_SCHEMA, as_items, channel_dates
from ..sources.manifests import children, delete_folder, latest, publish

BUCKETS = 64  # folders of links by hash at the start; doubled when they have grown, see `compact_history`
BUCKET_ROWS = 1_000_000  # links that a folder should hold
LOOKUP_LINKS = 100  # so many links or fewer are looked up by value, through the Bloom filters of the files
FILES_PER_BATCH = 1000  # feed files of one batch, whose paths the driver holds
MERGED = "merged"  # stream of the folders that compaction writes
LEVELS = 4  # merged generations beside each other before they are merged too
HISTORY_SCHEMA = (
    "item_title string, item_link string, item_description string, item_pub_date timestamp, feed string, "
    "feed_pub_date timestamp, bucket int, stream string, batch bigint"
)
_STATE = "kind string, stream string, batch bigint, buckets int"


class _State:
    """What the manifest of a history says: merged generations that count, batches they replace, number of folders."""

    def __init__(self, spark: SparkSession, history: str):
        _, rows = latest(spark, f"{history}/_manifest")
        self.live = sorted(r["batch"] for r in rows if r["kind"] == "live")
        self.retired = sorted((r["stream"], r["batch"]) for r in rows if r["kind"] == "retired")
        self.buckets = max((r["buckets"] for r in rows), default=BUCKETS)


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """All items, each once: batches that a merged generation replaces do not count, nor does an unfinished generation."""
    state = _State(spark, history)
    rows = spark.read.schema(HISTORY_SCHEMA).parquet(history)
    counts = (F.col("stream") != MERGED) | F.col("batch").isin(state.live)
    for stream in sorted({s for s, _ in state.retired}):  # folder names, so whole folders are skipped
        counts = counts & ((F.col("stream") != stream) | ~F.col("batch").isin([b for s, b in state.retired if s == stream]))
    return rows.filter(counts)


def _bucket(link: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(link), F.lit(buckets)).cast("int")


def unseen(links: DataFrame, history: DataFrame, stream: str, batch: int, buckets: int = BUCKETS) -> DataFrame:
    """Links that no other batch of any stream holds; only the folders of these links are read.

    Numbers of folders are BUCKETS times a power of two, so a link may lie in one folder for each number up to `buckets`.
    A few links are also looked up by value: files are sorted by link and have a Bloom filter for it, so row groups
    without them are skipped.
    """
    sizes = [BUCKETS]
    while sizes[-1] < buckets:
        sizes.append(2 * sizes[-1])
    places = links.select(F.explode(F.array(*[_bucket("item_link", n) for n in sizes])).alias("bucket"))
    used = [row.bucket for row in places.distinct().collect()]  # folder numbers
    others = (F.col("stream") != stream) | (F.col("batch") != batch)
    known = history.filter(F.col("bucket").isin(used) & others).select("item_link")
    few = [row.item_link for row in links.select("item_link").limit(LOOKUP_LINKS + 1).collect()]
    if 0 < len(few) <= LOOKUP_LINKS:
        known = known.filter(reduce(or_, [F.col("item_link") == F.lit(link) for link in few]))
    return links.join(known, "item_link", "left_anti")


def _store(rows: DataFrame, history: str) -> None:
    """Write the folders of `rows`, each in place of what it held; sorted, with a Bloom filter per row group."""
    writer = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "item_link").write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#item_link", "true")
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.partitionBy("bucket", "stream", "batch").parquet(history)


def ingest_feed(spark: SparkSession, src: str, history: str, checkpoint: str) -> None:
    """Add the items of the feed files that arrived since the last run, with their own date and that of their channel.

    Exact for any age of item: links are compared with the history, not with a watermarked window, so nothing
    late is lost. The history is filed by link hash, so a small run reads few of its folders. Duplicates inside
    a batch are folded before the shuffle. A batch owns the folders named by its stream (the id kept in the
    checkpoint) and number: repeated after a failure it writes the same again, and a new checkpoint starts a
    new stream beside the old ones. Each run adds small files; `compact_history` merges them.
    """
    spark.createDataFrame([], HISTORY_SCHEMA).write.mode("ignore").partitionBy("bucket", "stream", "batch").parquet(history)

    def add_unseen(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        buckets = _State(session, history).buckets
        newest = F.max_by(F.struct("item_title", "item_description", "item_pub_date", "feed"), F.struct("item_pub_date", "feed"))
        links = rows.groupBy("item_link").agg(newest.alias("item")).select("item_link", "item.*")
        links = links.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            new = unseen(links, read_history(session, history), stream, batch, buckets)
            files = [unquote(row.feed) for row in links.select("feed").distinct().collect()]  # FILES_PER_BATCH at most
            if files:
                new = new.join(F.broadcast(channel_dates(session, files)), "feed", "left")
            else:
                new = new.withColumn("feed_pub_date", F.lit(None).cast("timestamp"))
            new = new.withColumns(
                {"bucket": _bucket("item_link", buckets), "stream": F.lit(stream), "batch": F.lit(batch).cast("bigint")}
            )
            _store(new, history)
        finally:
            links.unpersist()

    source = spark.readStream.format("xml").option("rowTag", "item").option("recursiveFileLookup", True)
    (
        as_items(source.option("maxFilesPerTrigger", FILES_PER_BATCH).schema(ITEM_SCHEMA).load(src))
        .writeStream.foreachBatch(add_unseen)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def compact_history(spark: SparkSession, history: str, least_batches: int = 16) -> int:
    """Merge the batches since the last time into one generation, a sorted file or a few per folder; gives how many.

    Run it between ingests. Few batches (under `least_batches`) are left for later. A generation is merged again only when
    LEVELS of them stand beside each other; then all become one, and the number of folders is doubled until a folder
    holds BUCKET_ROWS links or fewer, so a link is rewritten about once per LEVELS generations. The manifest is written
    after the generation and before the replaced folders go, so a reader, and a run after a crash at any point, sees each
    link once. Merged rows keep their dates and feed; their stream is "merged".
    """
    state = _State(spark, history)
    _delete_batches(spark, history, state.retired)  # what a crash may have left
    rows = read_history(spark, history)
    batches = [(r.stream, r.batch) for r in rows.select("stream", "batch").distinct().collect()]  # folder names
    fresh = [b for b in batches if b[0] != MERGED]
    if len(fresh) < least_batches:
        return 0
    whole = len(state.live) >= LEVELS
    merged = batches if whole else fresh
    buckets = state.buckets
    if whole:
        n = rows.count()
        while n > buckets * BUCKET_ROWS:
            buckets *= 2
    generation = max([b for s, b in batches if s == MERGED] + state.live + [-1]) + 1
    chosen = rows if whole else rows.filter(F.col("stream") != MERGED)
    chosen = chosen.withColumns(
        {"bucket": _bucket("item_link", buckets), "stream": F.lit(MERGED), "batch": F.lit(generation).cast("bigint")}
    )
    _store(chosen, history)
    live = [generation] if whole else [*state.live, generation]
    manifest = [("live", MERGED, b, buckets) for b in live] + [("retired", s, b, buckets) for s, b in merged]
    publish(spark.createDataFrame(manifest, _STATE), f"{history}/_manifest")
    _delete_batches(spark, history, merged)
    return len(merged)


def _delete_batches(spark: SparkSession, history: str, batches: list[tuple[str, int]]) -> None:
    if not batches:
        return
    for bucket in children(spark, history):
        if bucket.startswith("bucket="):
            for stream in {s for s, _ in batches} & {n.removeprefix("stream=") for n in children(spark, f"{history}/{bucket}")}:
                for batch in [b for s, b in batches if s == stream]:
                    delete_folder(spark, f"{history}/{bucket}/stream={stream}/batch={batch}")
