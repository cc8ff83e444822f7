"""Importance resampling: documents drawn so that their words are distributed like those of a target collection."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .counting import summed_counts
from .storage import batches_by_bytes, stored

# ASCII digits and letters in lower case, and all that is not ASCII; for UTF-8 bytes.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
SENTINEL = b"\n"  # between the texts of a batch; not part of any word
BLOCK_BYTES = 1 << 20  # joined text that one regex pass reads; a longer single word is one block


def ngram_hashes(texts: pa.Array, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, row, crc32) of all runs of n = 1 to `longest` words of the texts, block by block; null counts as empty.

    The texts are joined with sentinels, one regex pass finds all words, and a search in the texts' offsets tells
    the row of each word. A run whose first and last word lie in different rows spans two texts and is left out.
    A run's words are joined by one space; its CRC follows from that of the run without its last word.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    data = SENTINEL.join(texts.cast(pa.binary()).to_pylist()).lower()
    sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
    offsets = np.cumsum(sizes + 1) - sizes - 1
    held: list[bytes] = []  # the last words of the block before, for runs that cross the blocks' border
    held_rows = np.zeros(0, np.int64)
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + BLOCK_BYTES)
        end = gap.start() if gap else len(data)
        found = list(_WORD.finditer(data, at, end))
        at = end
        starts = np.fromiter((m.start() for m in found), np.int64, len(found))
        words = held + [m[0] for m in found]
        rows = np.concatenate([held_rows, np.searchsorted(offsets, starts, "right") - 1])
        old = len(held)
        crcs: list[int] = list(map(zlib.crc32, words))
        for n in range(1, longest + 1):
            if n > 1:
                spaced = map(zlib.crc32, itertools.repeat(b" "), crcs)
                crcs = list(map(zlib.crc32, words[n - 1 :], spaced))  # ends with the shorter list
            first = max(0, old - n + 1)  # runs that end among the held words are counted already
            begin, last = rows[first : len(words) - n + 1], rows[first + n - 1 :]
            inside = begin == last
            yield n, begin[inside], np.array(crcs[first : len(words) - n + 1], np.int64)[inside]
        held = words[len(words) - longest + 1 :] if longest > 1 else []
        held_rows = rows[len(rows) - len(held) :]


def bucket_counts(df: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """How many n-grams of all texts fall in each bucket; tasks send one array of that size."""
    batches_by_bytes(df)

    def counts(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(buckets, np.int64)
        for _, _, crcs in ngram_hashes(batch.column(0), longest):
            total += np.bincount(crcs % buckets, minlength=buckets)
        return total

    return summed_counts(df.select(df[text].cast("string").alias("text")), counts, buckets)


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of target over source frequency) per bucket, each count plus one; in doubles."""
    have, want = float(source.sum()) + len(source), float(target.sum()) + len(target)
    ratios = [(float(t) + 1) * have / ((float(s) + 1) * want) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def importance_scores(
    docs: DataFrame, target: DataFrame, longest: int, buckets: int, seed: str, id: str = "doc_id", text: str = "text", target_text: str = "text"
) -> DataFrame:
    """(id, n_features, n_words, weight, score) per row: see `importance_resample`."""
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            features, words, weight = (np.zeros(rows, np.int64) for _ in range(3))
            for n, row, crcs in ngram_hashes(batch.column(1), longest):
                count = np.bincount(row, minlength=rows)
                features += count
                words += count if n == 1 else 0
                # sums of whole numbers below 2**53, so exact
                weight += np.bincount(row, gains[crcs % buckets], minlength=rows).astype(np.int64)
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in batch.column(2).to_pylist()]
            columns = [features, words, weight, weight + np.array(noise, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], ["id", "n_features", "n_words", "weight", "score"]
            )

    key = F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id].cast("string"), F.lit("")))
    draw = F.conv(F.left(F.sha2(key.cast("binary"), 256), F.lit(8)), 16, 10).cast("long")
    rows = docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"), draw.alias("draw"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"id {kind}, n_features long, n_words long, weight long, score long").withColumnRenamed("id", id)


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: str = "2024",
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """(id, n_features, n_words, weight, score, rank) per document; rank 1, 2, 3 ... for the drawn ones, else null.

    Words are runs of ASCII letters (in lower case), digits and characters beyond ASCII; features are all runs of 1 to
    `longest` words, each in the bucket that the CRC-32 of its UTF-8 bytes names. A bucket's gain is the floored 1000-fold
    logarithm of its share in `target` over its share in `docs` (counts plus one); a document's weight adds up the gains of
    its features. Its score is the weight plus Gumbel noise, drawn from SHA-256 of seed and id, so that the highest scores
    are a sample without replacement by importance. Of the N documents with `least_words` words or more, the
    floor(percent * N / 100) highest scores are drawn, ties to the smaller id.

    The counts take one pass over both tables and meet as arrays of fixed size; the second pass scores. Scores are sorted
    in ranges of (score, id) in parallel; a row's rank is its place in its range behind the sizes of the ranges before.

    A null text has no words. A null id counts as empty in the noise and comes last among ties; rows with equal ids stay
    separate documents. Without `target` rows the shares of an empty collection (all buckets alike) count. An empty
    table gives an empty one. Other columns of any name are ignored.
    """
    rows = stored(importance_scores(docs, target, longest, buckets, seed, id, text, target_text), "importance-scores")
    large = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last(id)]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            extra = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place + 1, place + n + 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "part", "place"])
            place += n

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    sorted_rows = rows.where(large).repartitionByRange(*order).sortWithinPartitions(*order)
    places = stored(sorted_rows.mapInArrow(numbered, f"{schema}, part int, place long"), "importance-places")
    sizes = places.groupBy("part").agg(F.count("*").alias("n"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.floor(F.sum("n").over(whole) * percent / 100).alias("drawn")
    )
    rank = F.col("start") + F.col("place")
    ranked = places.join(starts, "part").select(*rows.columns, F.when(rank <= F.col("drawn"), rank).alias("rank"))
    return ranked.unionByName(rows.where(~large).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, ranks: DataFrame, id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that were drawn, with all their columns."""
    return docs.join(ranks.where("rank is not null").select(id), id, "left_semi")
