"""Token-id output: documents in ascending id order, as wavelet-matrix shards, and the way back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import batches_by_bytes
from .tokens import encoder
from .wavelet import NULL_ID, open_shard, pack_shard

SHARD_TOKENS = 1 << 18  # a shard is closed by the document that reaches this many ids

SHARDS = "part int, shard int, n_docs long, n_tokens long, payload binary"


def write_shards(docs: DataFrame, path: str, vocabulary: str, end_id: int, id: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts, append `end_id` to each, and write the ids to `path` in ascending order of `id`.

    The output is a Parquet table in shared storage, one row per shard: `payload` is the shard file itself
    (see `wavelet`), (part, shard) its place in the order. Ranges of ids are sorted in parallel; a range may
    be written again by another executor without change.

    A null text is an empty document (the end id only). Null ids come first; rows with equal ids stay separate
    documents, in any order. An empty table gives no shard. Only `id` (whole numbers) and `text` are read.
    """
    batches_by_bytes(docs)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, shard = encoder(vocabulary), TaskContext.get().partitionId(), 0
        ids, docs_in, lengths, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal shard, ids, docs_in, lengths, held
            payload = pack_shard(np.concatenate(ids), np.array(docs_in, np.int64), np.array(lengths, np.int64))
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "shard": [shard], "n_docs": [len(docs_in)], "n_tokens": [held], "payload": [payload]},
                pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())]),
            )
            shard, ids, docs_in, lengths, held = shard + 1, [], [], [], 0
            return row

        for batch in batches:
            doc_ids = pa.compute.fill_null(batch.column(0), int(NULL_ID)).to_numpy(zero_copy_only=False)
            for first, end, found, offsets in encode.blocks(batch.column(1)):
                with_end = np.insert(found, offsets[1:], end_id).astype(np.uint32)
                ends = offsets[1:] + np.arange(1, end - first + 1)
                at = row = 0
                while row < end - first:
                    # rows up to the one that fills the shard
                    stop = min(int(np.searchsorted(ends, at + SHARD_TOKENS - held)) + 1, end - first)
                    sizes = np.diff(ends[row:stop], prepend=at)
                    ids.append(with_end[at : ends[stop - 1]])
                    docs_in += doc_ids[first + row : first + stop].tolist()
                    lengths += sizes.tolist()
                    held += int(sizes.sum())
                    at, row = int(ends[stop - 1]), stop
                    if held >= SHARD_TOKENS:
                        yield close()
        if docs_in:
            yield close()

    source = docs.select(docs[id].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    source.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(shards, SHARDS).write.parquet(path)


def _shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids in all shards before, from sums per shard and per range."""
    ranges = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("range_start"))
    in_range = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(in_range), F.lit(0)).alias("in_range"))
    return places.join(ranges, "part").select("part", "shard", (F.col("range_start") + F.col("in_range")).alias("shard_start"))


def count_tokens_in_shards(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of a few ids occurs in all shards; a shard walks from the id to its range in each plane."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0):
                matrix, _, _ = open_shard(payload.as_py())
                n = [matrix.count(token) for token in tokens]
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(n, pa.int64())], ["token", "n"])

    shards = spark.read.schema(SHARDS).parquet(path).select("payload")
    found = shards.mapInArrow(counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    asked = spark.createDataFrame([(t,) for t in sorted(set(tokens))], "token long")
    return asked.join(found, "token", "left").na.fill(0, ["n"])


def locate_token(spark: SparkSession, path: str, token: int, context: int = 0) -> DataFrame:
    """(position, doc_id, offset, around): every occurrence of an id, its place among all ids and in its document.

    `around` has the `context` ids before and after it, within its shard. A shard goes from its k-th occurrence back to the
    position (select), and from positions to ids (access); the other ids are not unpacked.
    """

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, payload in zip(*(batch.column(i) for i in range(3))):
                matrix, doc_ids, lengths = open_shard(payload.as_py())
                places = [matrix.occurrence(token, k) for k in range(matrix.count(token))]
                ends = np.cumsum(lengths)
                doc = np.searchsorted(ends, places, "right")
                around = [[matrix.access(j) for j in range(max(0, i - context), min(matrix.n, i + context + 1))] if context else [] for i in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * len(places), pa.int32()),
                        pa.array([shard.as_py()] * len(places), pa.int32()),
                        pa.array(places, pa.int64()),
                        pa.array(doc_ids[doc], mask=doc_ids[doc] == NULL_ID),
                        pa.array(np.array(places, np.int64) - (ends - lengths)[doc]),
                        pa.array(around, pa.list_(pa.int64())),
                    ],
                    ["part", "shard", "place", "doc_id", "offset", "around"],
                )

    shards = spark.read.schema(SHARDS).parquet(path)
    found = shards.select("part", "shard", "payload").mapInArrow(
        occurrences, "part int, shard int, place long, doc_id long, offset long, around array<long>"
    )
    return found.join(_shard_starts(shards), ["part", "shard"]).select(
        (F.col("shard_start") + F.col("place")).alias("position"), "doc_id", "offset", "around"
    )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token) for each row of `positions` (position: place among all ids); places beyond the ids are left out.

    Positions go to the shard that holds them; each is read by a walk through the planes.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    starts = _shard_starts(shards).join(shards.select("part", "shard", "n_tokens"), ["part", "shard"])
    # a row per 2**16 positions that a shard touches, so that the range join is an equi-join on these pieces
    step = 1 << 16
    touched = starts.where("n_tokens > 0").withColumn(
        "piece", F.explode(F.sequence(F.floor(F.col("shard_start") / step), F.floor((F.col("shard_start") + F.col("n_tokens") - 1) / step)))
    )
    asked = positions.select(F.col("position").cast("long").alias("position")).withColumn("piece", F.floor(F.col("position") / step))
    placed = asked.join(touched, "piece").where("position >= shard_start and position < shard_start + n_tokens")
    wanted = placed.select("part", "shard", "position", (F.col("position") - F.col("shard_start")).alias("place"))

    def read(key, asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"position": pa.array([], pa.int64()), "token": pa.array([], pa.int64())})
        matrix, _, _ = open_shard(held.column("payload")[0].as_py())
        tokens = [matrix.access(place) for place in asked.column("place").to_pylist()]
        return pa.table({"position": asked.column("position").combine_chunks(), "token": pa.array(tokens, pa.int64())})

    keys = ["part", "shard"]
    payloads = spark.read.schema(SHARDS).parquet(path).select(*keys, "payload")  # read anew: `wanted` is derived from `shards`
    return wanted.groupBy(*keys).cogroup(payloads.groupBy(*keys)).applyInArrow(read, "position long, token long")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, shard, offset) per document of written shards.

    `start` counts the ids of all documents before it. It comes from sums per shard and per range, so that
    only one row per range meets in one task.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    read = shards.select("part", "shard", "payload").mapInArrow(
        _documents, "part int, shard int, doc_id long, offset long, n_tokens long, ids_crc32 long"
    )
    return read.join(_shard_starts(shards), ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "part", "shard", "offset"
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, shard, payload in zip(*(batch.column(i) for i in range(3))):
            matrix, doc_ids, lengths = open_shard(payload.as_py())
            ids, ends = matrix.tokens(), np.cumsum(lengths)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(ends - lengths, ends)]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part.as_py(), np.int32)),
                    pa.array(np.full(n, shard.as_py(), np.int32)),
                    pa.array(doc_ids, mask=doc_ids == NULL_ID),
                    pa.array(ends - lengths),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "shard", "doc_id", "offset", "n_tokens", "ids_crc32"],
            )
