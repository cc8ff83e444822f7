"""Removal of lines that other documents hold too, found with two Bloom filters."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import lowered, span_hashes, text_blocks
from .storage import batches_by_bytes, stored

SLICE_BITS = 22  # bits of one slice of either filter
BITS_PER_LINE = 16

_SPACES = "\t\n\x0b\x0c\r "
_LOWER = {c: c + 32 for c in range(65, 91)}


def line_key(line: str) -> str:
    """The key of a line: white space stripped at both ends, A-Z in lower case."""
    return line.strip(_SPACES).translate(_LOWER)


def dedup_lines(docs: DataFrame, min_chars: int = 10, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated lines removed from `text`, and with n_lines (before) and n_dropped added.

    A line's key is the line without white space at its ends and with A-Z in lower case. Keys of at least
    `min_chars` code points that occur under two or more ids lose all their lines except under the smallest id.

    1. One scan leaves 64-bit key hashes per block of texts in shared storage.
    2. The hashes of each block, without repeats, go to the slices of the two filters. A slice takes a hash
       into "once", and into "twice" when "once" has it already; then it sends back what "twice" holds. The
       number of slices follows the number of lines, so a slice and a block are always small, and a line that
       is everywhere counts once per block.
    3. Only suspected lines are taken out of their texts and grouped by the whole key, which confirms repeats
       exactly and finds the smallest id. The remaining lines are joined again.

    Null and empty texts are one empty line; the result's text is never null. Rows with a null id are kept
    whole and count nowhere. Repeated rows count as one document, and each is cleaned. Empty tables and extra
    columns of any name pass through (n_lines and n_dropped are replaced).
    """
    batches_by_bytes(docs)
    others = [c for c in docs.columns if c not in (id, text)]
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *[docs[c] for c in others]).alias("row"),
        docs[id].alias("id"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    suspects = suspected_lines(rows.where("id is not null").select("id", "mark", "text"), min_chars)

    keyed = rows.join(suspects, ["id", "mark"]).select("id", "mark", "numbers", "text")
    keyed = keyed.mapInArrow(_line_keys, f"id {rows.schema['id'].dataType.simpleString()}, mark long, number int, key string")
    # both stored, so that the join below has plain shuffles on both sides and Spark can split a hot key
    keyed = stored(keyed, "suspected-lines")
    repeated = keyed.groupBy("key").agg(F.min("id").alias("keeper"), F.max("id").alias("last")).where("keeper <> last")
    repeated = stored(repeated.select("key", "keeper"), "repeated-lines")
    drops = keyed.join(repeated, "key").where("id <> keeper")
    drops = drops.groupBy("id", "mark").agg(F.collect_set("number").alias("drop"))
    drops = stored(drops, "line-drops")

    lines = F.split("text", "\n")
    cleaned = rows.join(drops, ["id", "mark"], "left").select("id", "row", "drop", "text", lines.alias("lines"))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    kept = F.array_join(F.transform(numbers, lambda i: F.get("lines", i)), "\n")
    cleaned_text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept)
    columns = {id: F.col("id"), text: cleaned_text} | {c: F.col(f"row.`{c}`") for c in others}
    out = [columns[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    dropped = F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop"))
    return cleaned.select(*out, F.size("lines").cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"))


def suspected_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, mark, numbers): line numbers whose key hash the "twice" filter holds; rows have id, mark, text."""
    kind = rows.schema["id"].dataType.simpleString()
    hashed = stored(
        rows.mapInArrow(_block_hashes(min_chars), f"block string, ids array<{kind}>, marks array<long>, n_lines long, "
                        "docs binary, numbers binary, hashes binary"),
        "line-hashes",
    )
    n_lines = hashed.agg(F.sum("n_lines")).first()[0] or 0
    slices = 1 << max(0, int(max(1, n_lines * BITS_PER_LINE) - 1).bit_length() - SLICE_BITS)
    sliced = hashed.select("block", "docs", "hashes").mapInArrow(
        _to_slices(slices), "slice long, block string, hashes binary, repeats binary"
    )
    found = sliced.groupBy("slice").applyInPandas(_through_filters, "block string, suspects binary")
    found = found.groupBy("block").agg(F.collect_list("suspects").alias("suspects"))
    return (
        hashed.join(found, "block")
        .select("ids", "marks", "docs", "numbers", "hashes", "suspects")
        .mapInArrow(_suspects_by_document, f"id {kind}, mark long, numbers array<int>")
        .groupBy("id", "mark")
        .agg(F.first("numbers").alias("numbers"))
    )


def _block_hashes(min_chars: int):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in text_blocks(batch.column(2)):
                raw = lowered(raw)
                docs, numbers, starts, ends = _stripped_lines(raw, offsets)
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])
                keep = points[ends] - points[starts] >= min_chars
                docs, numbers = docs[keep].astype("<i4"), numbers[keep].astype("<i4")
                keys = span_hashes(raw, starts[keep], ends[keep])
                ids, marks = batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uuid.uuid4().hex]),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), marks),
                        pa.array([len(keys)], pa.int64()),
                        pa.array([docs.tobytes()], pa.binary()),
                        pa.array([numbers.tobytes()], pa.binary()),
                        pa.array([keys.astype("<u8").tobytes()], pa.binary()),
                    ],
                    ["block", "ids", "marks", "n_lines", "docs", "numbers", "hashes"],
                )

    return hashes


def _stripped_lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, line number, start and end (without outer white space) of every line."""
    breaks = np.flatnonzero(raw == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    per_doc = np.diff(np.searchsorted(breaks, offsets)) + 1
    docs = np.repeat(np.arange(len(per_doc)), per_doc)
    numbers = np.arange(len(docs)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    solid = np.flatnonzero((raw > 0x20) | (raw < 0x09) | ((raw > 0x0D) & (raw < 0x20)))
    if not len(solid):
        return docs, numbers, starts, starts
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends)
    some = last > first
    starts = np.where(some, solid[np.minimum(first, len(solid) - 1)], starts)
    ends = np.where(some, solid[last - 1] + 1, starts)
    return docs, numbers, starts, ends


def _to_slices(slices: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, docs, hashes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                # one entry per key and text, then the keys of the block and those of more than one of its texts
                pairs = np.unique(np.rec.fromarrays([np.frombuffer(hashes, "<u8"), np.frombuffer(docs, "<i4")], names="h,d"))
                keys, counts = np.unique(pairs["h"], return_counts=True)
                at = np.searchsorted(keys >> np.uint64(64 - _log2(slices)), np.arange(slices + 1)) if slices > 1 else np.array([0, len(keys)])
                used = np.flatnonzero(np.diff(at))
                parts = [keys[at[s] : at[s + 1]] for s in used]
                more = [keys[at[s] : at[s + 1]][counts[at[s] : at[s + 1]] > 1] for s in used]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used.astype(np.int64)),
                        pa.array([block] * len(used), pa.string()),
                        pa.array([p.tobytes() for p in parts], pa.binary()),
                        pa.array([p.tobytes() for p in more], pa.binary()),
                    ],
                    ["slice", "block", "hashes", "repeats"],
                )

    return rows


def _log2(n: int) -> int:
    return n.bit_length() - 1


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash; the slice is chosen by the high bits, so these are the low ones."""
    mask = np.uint64((1 << SLICE_BITS) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(SLICE_BITS)) & mask).astype(np.int64)


def _through_filters(pdf: pd.DataFrame) -> pd.DataFrame:
    """One slice: fill "once" and "twice" from all blocks, then tell each block what "twice" holds."""
    once, twice = np.zeros(1 << SLICE_BITS, bool), np.zeros(1 << SLICE_BITS, bool)
    for hashes, repeats in zip(pdf["hashes"], pdf["repeats"]):
        a, b = _places(np.frombuffer(hashes, "<u8"))
        seen = once[a] & once[b]
        twice[a[seen]] = twice[b[seen]] = True
        once[a] = once[b] = True
        a, b = _places(np.frombuffer(repeats, "<u8"))
        twice[a] = twice[b] = True
    out = []
    for hashes in pdf["hashes"]:
        hashes = np.frombuffer(hashes, "<u8")
        a, b = _places(hashes)
        out.append(hashes[twice[a] & twice[b]].tobytes())
    return pd.DataFrame({"block": pdf["block"], "suspects": out})


def _line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per suspected line, with its whole key."""
    for batch in batches:
        keys, rows = [], []
        for row, (numbers, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
            lines = text.as_py().split("\n")
            keys += [line_key(lines[n]) for n in numbers]
            rows += [row] * len(numbers)
        rows = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(2).flatten(), pa.array(keys, pa.string())],
            ["id", "mark", "number", "key"],
        )


def _suspects_by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            docs, numbers = (np.frombuffer(batch.column(i)[row].as_py(), "<i4") for i in (2, 3))
            hashes = np.frombuffer(batch.column(4)[row].as_py(), "<u8")
            suspects = np.frombuffer(b"".join(batch.column(5)[row].as_py()), "<u8")
            hit = np.isin(hashes, suspects)
            docs, numbers = docs[hit], numbers[hit]
            some, at = np.unique(docs, return_index=True)
            ends = np.append(at, len(docs)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[row].values.take(pa.array(some)),
                    batch.column(1)[row].values.take(pa.array(some)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers)),
                ],
                ["id", "mark", "numbers"],
            )
