"""Best-fit packing of documents into sequences, improved by bin completion."""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import batches_by_bytes, stored
from .tokens import encoder

GROUP_PIECES = 4096  # pieces that one task packs at a time
SEARCH_NODES = 4000  # bins that the search of one group may try; beyond it the best packing found so far stands
FILLINGS = 6  # fillings tried for one bin before its largest piece is moved on

PIECES = "id {id}, piece int, start long, length long, ids_crc32 long"


def document_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id: str, text: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each text's ids with `end_id` behind them, cut every `capacity` ids."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for first, end, found, offsets in encode.blocks(batch.column(1)):
                ids = np.insert(found, offsets[1:], end_id).astype(np.uint32)
                ends = offsets[1:] + np.arange(1, end - first + 1)
                sizes = np.diff(ends, prepend=0)
                many = -(-sizes // capacity)
                row = np.repeat(np.arange(end - first), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                at = (ends - sizes)[row] + start
                crcs = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(first + row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.select(id).schema[0].dataType.simpleString()
    source = docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"))
    return source.mapInArrow(pieces, PIECES.format(id=kind))


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Texts go through the tasks once; only lengths are shuffled. Random groups of about GROUP_PIECES pieces are
    packed side by side. The bins that a group leaves with room to spare go into the next round, in fewer
    groups, until one group holds what is left; so the number of open bins does not grow with the groups.
    Full bins stay as they are.

    A null or empty text is one piece with the end id only. Null ids and repeated rows are packed like any
    other. An empty table gives an empty one. Only `id` and `text` are read.
    """
    batches_by_bytes(docs)
    spark = docs.sparkSession
    left = stored(document_pieces(docs, vocabulary, end_id, capacity, id, text), "pieces")
    kind, count = left.schema["id"].dataType.simpleString(), left.count()
    schema = PIECES.format(id=kind) + ", sequence_id long, offset long, settled boolean"
    done, level = [], 0
    while True:
        groups = max(1, -(-count // GROUP_PIECES))
        # by the place in the stored table, so that repeated rows spread as well
        salt = F.pmod(F.xxhash64(F.lit(level), F.monotonically_increasing_id()), F.lit(groups))
        packed = left.withColumn("group", salt).groupBy("group").applyInPandas(_packer(capacity, level, groups == 1), schema)
        packed = stored(packed, "packed")
        done.append(packed.where("settled"))
        if groups == 1:
            break
        left = packed.where("not settled").drop("sequence_id", "offset", "settled")
        fewer = left.count()
        if 10 * fewer > 9 * count or level == 60:  # what is left fills bins badly in any company: these bins stand
            done.append(packed.where("not settled"))
            break
        count, level = fewer, level + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(F.col("id").alias(id), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _packer(capacity: int, level: int, last: bool):
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy()
        bins = pack_lengths(lengths, capacity)
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        settled = np.ones(len(pdf), bool)
        for number, members in enumerate(bins):
            sizes = lengths[members]
            sequence[members] = (int(key[0]) * 64 + level) * (1 << 20) + number
            offset[members] = np.cumsum(sizes) - sizes
            settled[members] = last or sizes.sum() >= 0.98 * capacity
        return pdf.drop(columns="group").assign(sequence_id=sequence, offset=offset, settled=settled)

    return pack


def pack_lengths(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of positions; the fewer of best-fit decreasing and what bin completion finds."""
    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = lengths.tolist()
    incumbent = _best_fit(order, sizes, capacity)
    bound = -(-sum(sizes) // capacity)
    if len(incumbent) > bound:
        found = _complete_bins(Counter(sizes), capacity, len(incumbent), bound)
        if found is not None:
            where: dict[int, list[int]] = {}
            for i in order:
                where.setdefault(sizes[i], []).append(i)
            return [[where[size].pop() for size in filling] for filling in found]
    return incumbent


def _best_fit(order: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit in the given order: each piece goes to the fullest bin that has room for it."""
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    for i in order:
        at = bisect.bisect_left(free, (sizes[i], -1))
        if at < len(free):
            room, number = free.pop(at)
        else:
            room, number = capacity, len(bins)
            bins.append([])
        bins[number].append(i)
        if room > sizes[i]:
            bisect.insort(free, (room - sizes[i], number))
    return bins


def _complete_bins(counts: Counter, capacity: int, incumbent: int, bound: int) -> list[list[int]] | None:
    """Depth-first bin completion; a packing with fewer bins than `incumbent`, or None.

    A bin starts with the largest piece left. Its undominated fillings are tried, the fullest first. A branch
    ends when the waste of its bins is more than a packing with one bin less can have.
    """
    left = dict(counts)
    sizes = sorted(left, reverse=True)
    allowed = (incumbent - 1) * capacity - sum(size * n for size, n in left.items())
    best, nodes = None, 0
    path: list[tuple[list[int], Iterator[list[int]], int]] = []  # chosen filling, the fillings after it, waste before
    waste, total = 0, sum(left.values())

    def take(filling: list[int], sign: int) -> None:
        for size in filling:
            left[size] -= sign

    def fillings_of_next() -> Iterator[list[int]]:
        largest = next(size for size in sizes if left[size])
        return iter([[largest, *rest] for rest in _fillings(left, sizes, largest, capacity - largest)])

    options = fillings_of_next()
    while True:
        filling = next(options, None)
        if filling is not None and nodes < SEARCH_NODES:
            nodes += 1
            more = waste + capacity - sum(filling)
            if more > allowed:
                continue
            take(filling, 1)
            total -= len(filling)
            path.append((filling, options, waste))
            waste = more
            if total:
                options = fillings_of_next()
                continue
            best = [chosen for chosen, _, _ in path]
            allowed = (len(best) - 1) * capacity - sum(size * n for size, n in counts.items())
            if len(best) <= bound:
                return best
        if not path or nodes >= SEARCH_NODES:
            return best
        filling, options, waste = path.pop()
        take(filling, -1)
        total += len(filling)


def _fillings(left: dict[int, int], sizes: list[int], first: int, room: int) -> list[list[int]]:
    """Undominated ways to fill `room`, the fullest first: a piece, and behind it the largest that fit.

    A filling is dropped when another one holds a piece at least as large in place of each of its pieces.
    """
    usable = sorted(size for size, n in left.items() if n - (size == first) > 0 and size <= room)
    if not usable:
        return [[]]
    free = dict(left)
    free[first] -= 1

    found: dict[tuple[int, ...], int] = {}
    for a in reversed(usable[-64:]):
        held, space, at = (a,), room - a, bisect.bisect_right(usable, min(a, room - a)) - 1
        while at >= 0:
            size = usable[at]
            n = min(free[size] - (size == a), space // size)
            held += (size,) * n
            space -= n * size
            at = min(at, bisect.bisect_right(usable, space)) - 1
        found[held] = sum(held)
        if sum(held) == room and len(found) >= FILLINGS:
            break
    kept: list[tuple[int, ...]] = []
    for held in sorted(found, key=lambda h: (-found[h], -h[0])):
        if not any(len(k) >= len(held) and all(x >= y for x, y in zip(k, held)) for k in kept):
            kept.append(held)
        if len(kept) == FILLINGS:
            break
    return [list(held) for held in kept]
