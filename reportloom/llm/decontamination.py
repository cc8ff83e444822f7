"""Benchmark passages in documents: SimHash windows, multi-index Hamming search, short exact windows, exact verification."""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .hashing import NOT_IN_WORD, chained, folded, span_hashes, text_blocks, word_spans
from .storage import batches_by_bytes

RADIUS = 8  # differing bits of 64 that are always found
BLOCKS = (21, 21, 22)  # bits per block: within the radius, one block differs in RADIUS // 3 bits at most
GRID = 2  # windows begin and end at multiples of so many words of a block (1 for items of a few words)
SHORT = 8  # words of an item from which the grid is used
CLASS_RATIO = 1.2  # items of one size class differ in length by this factor at most
BATCH_BYTES = 256 << 10  # benchmark text sent to the tasks at once, so that the tables stay sparse; more goes in further rounds

def word_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, word lengths in bytes, first word of each row) per block of texts."""
    for first, end, raw, offsets in text_blocks(texts):
        raw = folded(raw)
        starts, ends, firsts = word_spans(raw, offsets, NOT_IN_WORD)
        yield first, end, span_hashes(raw, starts, ends), ends - starts, firsts


def sign_sums(hashes: np.ndarray, sizes: np.ndarray, grid: int) -> np.ndarray:
    """Running SimHash sums: row i adds up +-weight of the first grid * i words for each of 64 bits.

    Longer words weigh more, up to 12. Sums wrap around in 16 bits; differences over a window do not.
    """
    n = -(-len(hashes) // grid)
    signs = np.zeros((n * grid, 64), np.int8)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).view(np.int8)
    np.multiply(2 * bits - 1, np.minimum(sizes, 12).astype(np.int8)[:, None], out=signs[: len(hashes)])
    signs = sum(signs[i::grid] for i in range(grid))
    out = np.zeros((64, n + 1), np.int16)  # sums run along the memory, windows read whole rows
    np.cumsum(np.ascontiguousarray(signs.T), axis=1, dtype=np.int16, out=out[:, 1:])
    return np.ascontiguousarray(out.T)


def simhashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of word windows; starts and ends in steps of the grid."""
    return np.packbits(sums[ends] - sums[starts] > 0, axis=1).view(np.uint64).ravel()


class Items:
    """The benchmark as the tasks need it: size classes with their windows and block tables, and shingles."""

    def __init__(self, items: list[tuple[int, str]], words: int, threshold: float):
        self.words = words
        self.ids, self.hashes, self.sizes = [], [], []
        texts = pa.array([text or "" for _, text in items], pa.string())
        for first, end, hashes, sizes, firsts in word_hashes(texts):
            for row in range(first, end):
                span = slice(firsts[row - first], firsts[row - first + 1])
                if span.stop > span.start:
                    self.ids.append(items[row][0])
                    self.hashes.append(hashes[span])
                    self.sizes.append(sizes[span])
        found = [np.unique(shingles(h, words), return_counts=True) for h in self.hashes]
        self.known = np.unique(np.concatenate([f for f, _ in found])) if found else np.zeros(0, np.uint64)
        # per item, the places of its shingles in `known`, and how often it has each
        self.shingles = [(np.searchsorted(self.known, f), n) for f, n in found]
        self.short = {len(h) for h in self.hashes if len(h) < words}
        self.classes = self._classes()
        self.seed_first, self.seed_item = self._seeds(threshold)

    def _seeds(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(first entry per known shingle, items): per item so many of its shingles that no similar span lacks all of them.

        A similar span holds `threshold` of the item's shingles at least. Those that fewest items have are taken.
        """
        holders = np.bincount(np.concatenate([f for f, _ in self.shingles]), minlength=len(self.known)) if self.shingles else []
        codes, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, (found, n) in enumerate(self.shingles):
            order = np.argsort(holders[found], kind="stable")
            spare = n.sum() - max(1, math.ceil(threshold * n.sum() - 1e-9))
            chosen = found[order[: np.searchsorted(np.cumsum(n[order]), spare, "right") + 1]]
            codes.append(chosen)
            items.append(np.full(len(chosen), i))
        code, item = np.concatenate(codes), np.concatenate(items)
        order = np.argsort(code, kind="stable")
        return np.searchsorted(code[order], np.arange(len(self.known) + 1)), item[order]

    def _classes(self) -> list[dict]:
        order = sorted(range(len(self.ids)), key=lambda i: len(self.hashes[i]))
        classes, at = [], 0
        while at < len(order):
            least = len(self.hashes[order[at]])
            members = list(itertools.takewhile(lambda i: len(self.hashes[i]) <= least * CLASS_RATIO, order[at:]))
            at += len(members)
            grid = 1 if least < SHORT else GRID
            step = grid * max(1, least // (4 * grid))
            window = (least - step + 1) // grid * grid
            prints, item = [], []
            for i in members:
                # The windows of any text that begin at multiples of `step` have one at each run of `step` places;
                # both ends of the item are covered, and a verbatim passage has equal fingerprints at both.
                last = max(0, len(self.hashes[i]) - window)
                shifts = sorted({*range(min(step, last + 1)), *range(max(0, last - step + 1), last + 1)})
                for x in shifts:
                    cut = slice(x, x + window)
                    sums = sign_sums(self.hashes[i][cut], self.sizes[i][cut], grid)
                    prints.append(simhashes(sums, np.array([0]), np.array([len(sums) - 1])))
                item += [i] * len(shifts)
            classes.append({"grid": grid, "step": step, "window": window, "prints": np.concatenate(prints), "item": np.array(item)})
        return classes

    def tables(self, prints: np.ndarray) -> list[np.ndarray]:
        """Per block, which values are within RADIUS // 3 bits of some item's block."""
        out, low = [], 0
        for width in BLOCKS:
            flips = [0]
            for n in range(1, RADIUS // len(BLOCKS) + 1):
                flips += [sum(1 << b for b in bits) for bits in itertools.combinations(range(width), n)]
            values = ((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
            table = np.zeros(1 << width, bool)
            table[np.unique(values)[:, None] ^ np.array(flips)] = True
            out.append(table)
            low += width
        return out


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of `words` words; of fewer words, the whole sequence."""
    return chained(hashes, min(words, len(hashes))) if len(hashes) else hashes


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = 5,
    threshold: float = 0.8,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item_id, similarity, start_word, n_words): documents with a span similar to a benchmark item.

    Words are runs of letters, digits and non-ASCII characters; A-Z and U+00C0 to U+00DE are lower-cased. The
    similarity is that of the multisets of `words`-word shingles: the sum of the smaller counts over the sum
    of the larger ones, at least `threshold`. One row per document and item, with the best span.

    Items of about equal length form a size class. A document's windows of the class's size begin every few
    words; each item is fingerprinted at as many shifts, so a verbatim passage always has a window with an
    equal fingerprint. Fingerprints within RADIUS bits of an item's are found without loss: three blocks are
    looked up in tables that hold all values within a third of the radius. A similar passage may differ by more than
    the radius (a block of words in its middle is new or gone), so items have short windows of `words` words as well,
    looked up by their whole hash: at so many places that a similar passage leaves one of them untouched.
    The texts found by either are compared in full, with the spans of every length that can reach the threshold, so
    that no passage is missed but for collisions of 64 bits.

    No shuffle of the texts, and one pass over them for each round of BATCH_BYTES of benchmark text (about a
    thousand items), which is what is sent to the tasks. Null and empty texts or items match nothing; null ids are kept; repeated rows give
    repeated rows; empty tables give an empty one. Only the named columns are read.
    """
    batches_by_bytes(docs)
    spark = docs.sparkSession
    items = benchmark.select(benchmark[item_id].alias("item"), benchmark[item_text].cast("string").alias("text"))
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-volume // BATCH_BYTES))
    found = None
    for part in range(rounds):
        chosen = items if rounds == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(rounds)) == part)
        shared = spark.sparkContext.broadcast([tuple(r) for r in chosen.collect()])
        more = docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text")).mapInArrow(
            _matches(shared, words, threshold, to_arrow_type(items.schema["item"].dataType)),
            f"id {docs.select(id).schema[0].dataType.simpleString()}, item {items.schema['item'].dataType.simpleString()}, "
            "similarity double, start_word long, n_words long",
        )
        found = more if found is None else found.unionByName(more)
    return found.withColumnsRenamed({"id": id, "item": item_id})


_prepared: dict[str, tuple[Items, list[list[np.ndarray]]]] = {}


def _matches(shared: Broadcast, words: int, threshold: float, item_type: pa.DataType):
    key = uuid.uuid4().hex

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _prepared:  # the worker keeps the tables of one round
            _prepared.clear()
            items = Items(shared.value, words, threshold)
            _prepared[key] = items, [items.tables(c["prints"]) for c in items.classes]
        items, tables = _prepared[key]
        for batch in batches:
            rows, found = [], []
            for first, _, hashes, sizes, firsts in word_hashes(batch.column(1)):
                for doc, item, similarity, start, n in _block_matches(items, tables, hashes, sizes, firsts, threshold):
                    rows.append(first + doc)
                    found.append((items.ids[item], similarity, start, n))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array([f[0] for f in found], item_type),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.int64()),
                ],
                ["id", "item", "similarity", "start_word", "n_words"],
            )

    return matches


def _block_matches(items: Items, tables: list, hashes: np.ndarray, sizes: np.ndarray, firsts: np.ndarray, threshold: float):
    """(text, item, similarity, first word, words) of one block of texts, the best per text and item."""
    if not len(hashes) or not items.ids:
        return []
    sums = {grid: sign_sums(hashes, sizes, grid) for grid in {c["grid"] for c in items.classes}}
    known = np.zeros(len(hashes), bool)
    places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # per shingle size: word, place in items.known, first one per text
    for n in {items.words, *items.short}:
        if len(hashes) < n:
            continue
        runs = chained(hashes, n)
        code = np.minimum(np.searchsorted(items.known, runs), len(items.known) - 1)
        at = np.flatnonzero(items.known[code] == runs)
        at = at[at + n <= firsts[np.searchsorted(firsts, at, "right")]]
        known[at] = True
        places[n] = at, code[at], np.searchsorted(at, firsts)
    near = np.concatenate([[0], np.cumsum(known)])
    pairs: set[tuple[int, int]] = set()
    for at, code, _ in places.values():
        n = items.seed_first[code + 1] - items.seed_first[code]
        entry = np.repeat(items.seed_first[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc = np.repeat(np.searchsorted(firsts, at, "right") - 1, n)
        found = np.unique(doc * len(items.ids) + items.seed_item[entry])
        pairs.update(zip((found // len(items.ids)).tolist(), (found % len(items.ids)).tolist()))
    for size_class, blocks in zip(items.classes, tables):
        grid, step, window = size_class["grid"], size_class["step"], size_class["window"]
        starts = np.arange(0, len(hashes), step)
        doc = np.searchsorted(firsts, starts, "right") - 1
        ends = np.minimum(starts + window, firsts[doc + 1] // grid * grid)
        whole = 4 * (ends - starts) >= 3 * window
        doc, starts, ends = doc[whole], starts[whole], ends[whole]
        for a in range(0, len(starts), 1 << 15):
            prints = simhashes(sums[grid], starts[a : a + (1 << 15)] // grid, ends[a : a + (1 << 15)] // grid)
            low, hit = 0, np.zeros(len(prints), bool)
            for width, block in zip(BLOCKS, blocks):
                hit |= block[((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)]
                low += width
            hit = np.flatnonzero(hit)
            for some in np.array_split(hit, max(1, len(hit) * len(size_class["prints"]) // 4_000_000)):
                off = np.bitwise_count(prints[some][:, None] ^ size_class["prints"][None, :])
                window_at, entry = np.nonzero(off <= RADIUS)
                place = some[window_at] + a
                # a span with no shingle of the benchmark is like no item
                used = near[ends[place]] > near[starts[place]]
                place, entry = place[used], entry[used]
                pairs.update(zip(doc[place].tolist(), size_class["item"][entry].tolist()))
    out = []
    for d, item in sorted(pairs):
        k = min(items.words, len(items.hashes[item]))
        if k in places:
            at, code, first = places[k]
            span = slice(first[d], first[d + 1])
            similarity, start, n = _best_span(*items.shingles[item], at[span], code[span], threshold)
            if similarity >= threshold:
                out.append((d, item, similarity, start - int(firsts[d]), n + k - 1))
    return out


def _best_span(want: np.ndarray, wanted: np.ndarray, at: np.ndarray, code: np.ndarray, threshold: float) -> tuple[float, int, int]:
    """(similarity, first word, shingles) of the text's most similar span, of any length that can reach the threshold.

    `want` and `wanted` are the item's shingles and their counts; `at` and `code` the text's shingles that any item
    has. A best span begins and ends with a shingle of the item, as cutting off another one raises the similarity. Of equal
    spans the first counts, then the longest.
    """
    total, best = int(wanted.sum()), (0.0, 0, 0)
    number = np.minimum(np.searchsorted(want, code), len(want) - 1)
    shared = want[number] == code
    at, number = at[shared], number[shared]
    ends = np.searchsorted(at, at + math.floor(total / threshold + 1e-9))
    room = ends - np.arange(len(at))
    usable = np.flatnonzero(room >= threshold * total - 1e-9)
    if not len(usable):
        return best
    # a shingle counts in a span if the span begins after the one that comes as many times before it as the item has it
    order = np.argsort(number, kind="stable")
    before = np.arange(len(at)) - wanted[number[order]]
    same = (before >= 0) & (number[order[np.maximum(before, 0)]] == number[order])
    blocker = np.full(len(at), -1)
    blocker[order[same]] = order[before[same]]
    for i in usable.tolist():
        if min(room[i], total) <= best[0] * total:
            continue
        common = np.cumsum(blocker[i : ends[i]] < i)
        length = at[i : ends[i]] - at[i] + 1
        similarity = common / (length + total - common)
        j = len(similarity) - 1 - int(np.argmax(similarity[::-1]))
        if similarity[j] > best[0]:
            best = float(similarity[j]), int(at[i]), int(length[j])
    return best
