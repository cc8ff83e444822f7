"""A file format for token ids: a wavelet matrix per shard.

The ids of a shard are kept as bit-planes, highest bit first. Below each plane the ids with a 0 bit come
before those with a 1 bit, in their old order, so that `rank` and `select` on the planes walk from a position
to its id and from an id to its positions. Each plane is compressed on its own, next to a directory of counts, so that a
look-up opens the planes it walks through and counts at most WORD bits in each.

Layout (little endian): magic, then a zstd frame per section, each with a 32-bit length before it:
header int64 [tokens, documents, planes], document ids int64 (smallest value for null), document lengths int64, then per
plane the rank directory (uint32, the 1 bits before each run of WORD bits and their number) and the packed bits.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from functools import cached_property, partial

import numpy as np
import zstandard

MAGIC = b"WMX2"
NULL_ID = np.iinfo(np.int64).min
WORD = 512  # bits per entry of a rank directory


def rank_directory(packed: np.ndarray) -> np.ndarray:
    """1 bits before each run of WORD bits, and in all."""
    per = WORD // 8
    padded = np.zeros(-(-len(packed) // per) * per, np.uint8)
    padded[: len(packed)] = packed
    return np.concatenate([[0], np.cumsum(np.bitwise_count(padded).reshape(-1, per).sum(1, dtype=np.int64))])


class BitPlane:
    """Bits with rank and select; directory and bits are unpacked when they are first needed."""

    def __init__(self, directory: Callable[[], np.ndarray], packed: Callable[[], np.ndarray], n: int):
        self._directory, self._packed, self.n = directory, packed, n

    @cached_property
    def before(self) -> np.ndarray:
        return self._directory()

    @cached_property
    def packed(self) -> np.ndarray:
        return self._packed()

    @property
    def ones(self) -> int:
        return int(self.before[-1])

    @property
    def zeros(self) -> int:
        return self.n - self.ones

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n, bitorder="little").view(bool)

    def get(self, i: int) -> int:
        return int(self.packed[i >> 3] >> (i & 7)) & 1

    def rank(self, bit: int, i: int) -> int:
        """How many of the first i bits equal `bit`."""
        word = i // WORD
        part = self.packed[word * WORD // 8 : -(-i // 8)].copy()
        if i & 7 and len(part):
            part[-1] &= (1 << (i & 7)) - 1
        ones = int(self.before[word]) + int(np.bitwise_count(part).sum())
        return ones if bit else i - ones

    def select(self, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit equal to `bit`."""
        counts = self.before if bit else np.minimum(np.arange(len(self.before)) * WORD, self.n) - self.before
        word = int(np.searchsorted(counts, k, "right")) - 1
        start = word * WORD
        bits = np.unpackbits(self.packed[start // 8 : (start + WORD) // 8], bitorder="little")[: self.n - start]
        return start + int(np.flatnonzero(bits == bit)[k - int(counts[word])])


class WaveletMatrix:
    """Access, counting and occurrence lookup over the ids of one shard."""

    def __init__(self, planes: list[BitPlane], n: int):
        self.planes, self.n = planes, n

    @staticmethod
    def planes_of(ids: np.ndarray) -> list[np.ndarray]:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        for level in range(width - 1, -1, -1):
            bits = (ids >> level) & 1 != 0
            planes.append(np.packbits(bits, bitorder="little"))
            if level:
                ids = np.concatenate([np.compress(~bits, ids), np.compress(bits, ids)])
        return planes

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for plane in self.planes:
            bit = plane.get(i)
            value = value << 1 | bit
            i = plane.rank(bit, i) + (plane.zeros if bit else 0)
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        if value < 0 or value.bit_length() > len(self.planes):
            return 0, 0
        for level, plane in enumerate(self.planes):
            bit = value >> (len(self.planes) - 1 - level) & 1
            shift = plane.zeros if bit else 0
            start, end = plane.rank(bit, start) + shift, plane.rank(bit, end) + shift
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs in [start, end)."""
        a, b = self._range(value, start, self.n if end is None else end)
        return b - a

    def occurrence(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id; -1 if there are fewer."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= k < b - a:
            return -1
        at = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            plane = self.planes[level]
            bit = value >> (len(self.planes) - 1 - level) & 1
            at = plane.select(bit, at - plane.zeros if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """All ids in order, undone plane by plane from the lowest bit."""
        width = len(self.planes)
        ids = np.zeros(self.n, np.uint16 if width <= 16 else np.uint32)
        for level in range(width - 1, -1, -1):
            plane = self.planes[level]
            bits = plane.bits()
            ids[plane.zeros :] |= ids.dtype.type(1 << (width - 1 - level))
            above = np.empty_like(ids)
            above[np.flatnonzero(~bits)] = ids[: plane.zeros]
            above[np.flatnonzero(bits)] = ids[plane.zeros :]
            ids = above
        return ids.astype(np.uint32)


def pack_shard(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    planes = WaveletMatrix.planes_of(ids)
    sections = [np.array([len(ids), len(doc_ids), len(planes)], "<i8"), doc_ids.astype("<i8"), lengths.astype("<i8")]
    for plane in planes:
        sections += [rank_directory(plane).astype("<u4"), plane]
    press = zstandard.ZstdCompressor(level=1)
    out = [MAGIC]
    for section in sections:
        frame = press.compress(section.tobytes())
        out += [struct.pack("<I", len(frame)), frame]
    return b"".join(out)


def open_shard(payload: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """(ids, document ids, document lengths) of a shard."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token shard")
    at, frames = 4, []
    while at < len(payload):
        (size,) = struct.unpack_from("<I", payload, at)
        frames.append((at + 4, at + 4 + size))
        at += 4 + size

    def section(number: int, kind: str) -> np.ndarray:
        start, end = frames[number]
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[start:end]), kind)

    n, _, width = section(0, "<i8").tolist()
    planes = [
        BitPlane(lambda i=i: section(3 + 2 * i, "<u4").astype(np.int64), partial(section, 4 + 2 * i, np.uint8), n) for i in range(width)
    ]
    return WaveletMatrix(planes, n), section(1, "<i8"), section(2, "<i8")
