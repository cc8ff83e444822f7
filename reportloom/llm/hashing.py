"""64-bit hashes of words and word shingles for whole Arrow columns, as numpy arrays.

The text is never turned into Python strings: words are found in the UTF-8 bytes, and their hashes are made from eight bytes
at a time, or, for long spans, from running sums of a polynomial over their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19  # bytes of text hashed at once; a longer single text is one block

PRIME = (1 << 61) - 1
_BASE = 0x0B7E151628AED2A6 % PRIME  # any fixed number below PRIME would do
_INVERSE = pow(_BASE, -1, PRIME)
SHORT_SPAN = 64
LONG_SPAN = 1 << 22  # bytes; the sum of a longer span could pass 64 bits and is put together from parts
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_IN_WORD = np.ones(256, bool)  # ASCII other than letters and digits
NOT_IN_WORD[48:58] = NOT_IN_WORD[65:91] = NOT_IN_WORD[97:123] = NOT_IN_WORD[128:] = False
_halves = [np.zeros(0, np.uint64)] * 2
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first n bytes
_S30, _S31, _S61 = np.uint64(30), np.uint64(31), np.uint64(61)


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for any 64-bit x."""
    x = (x & _P) + (x >> _S61)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, for a and b below PRIME, in halves of 31 bits (2**61 counts as 1)."""
    a1, a0, b1, b0 = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced(np.uint64(2) * a1 * b1 + (middle >> _S30) + ((middle & _LOW30) << _S31) + a0 * b0)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo PRIME, kept between calls."""
    known = _powers[base]
    if len(known) < n:
        size = max(n, BLOCK_BYTES + 1)
        while len(known) < size:
            step = np.uint64(pow(base, len(known), PRIME))
            known = np.concatenate([known, _times(known, step)])
        _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into the bytes) of consecutive rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    rows = len(texts)
    if not rows:
        return
    wide = pa.types.is_large_string(texts.type)
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + rows + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, raw[ends[first] : ends[end]], ends[first : end + 1] - ends[first]
        first = end


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span; equal bytes give equal hashes wherever they stand.

    Up to SHORT_SPAN bytes, eight bytes at a time are mixed into the hash. Longer spans take the value at _BASE of the
    polynomial whose coefficients are the bytes, modulo the prime 2**61 - 1: two different spans of n bytes have equal
    values for at most n of all bases. Neither way lets a pattern of bytes collide by its structure, as a sum modulo a power of
    two does.
    """
    sizes = ends - starts
    out = mixed(sizes.astype(np.uint64))
    if not len(raw):
        return out
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    eights = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    at, left, value, some = starts, np.where(sizes > SHORT_SPAN, 0, sizes), out, None  # long spans follow below
    while True:
        value = mixed(value ^ (eights[at] & _FIRST_BYTES[np.minimum(left, 8)])) + _STEP
        if some is None:
            out = np.where(left > 0, value, out)
        else:
            out[some] = value
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        some = more if some is None else some[more]
        at, left, value = at[more] + 8, left[more] - 8, value[more]
    long = np.flatnonzero(sizes > SHORT_SPAN)
    if len(long):
        out[long] = _long_hashes(raw, starts[long], ends[long])
    return out


def _long_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    if 2 * int(sizes.sum()) < len(raw):  # few of the bytes: only these are summed
        upto = np.cumsum(sizes)
        raw = raw[np.repeat(starts - (upto - sizes), sizes) + np.arange(upto[-1])]
        starts, ends = upto - sizes, upto
    sums = running_sums(raw)
    value = _span_sums(sums, starts, ends)
    for i in np.flatnonzero(sizes > LONG_SPAN):
        cuts = np.append(np.arange(starts[i], ends[i], LONG_SPAN), ends[i])
        value[i] = np.uint64(int(_span_sums(sums, cuts[:-1], cuts[1:]).astype(object).sum()) % PRIME)
    return mixed(_times(value, powers(_INVERSE, len(sums[0]))[starts]) + (sizes.astype(np.uint64) << _S61))


def running_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums, modulo 2**64, of the bytes (plus one) times the upper and the lower half of the powers."""
    if len(_halves[0]) < len(raw):
        power = powers(_BASE, max(len(raw), BLOCK_BYTES))
        _halves[:] = power >> _S31, power & _LOW31
    values = raw.astype(np.uint64)
    values += np.uint64(1)
    sums = np.zeros((2, len(raw) + 1), np.uint64)
    for part, half in zip(sums, _halves):
        np.multiply(values, half[: len(raw)], out=part[1:])
        np.cumsum(part[1:], out=part[1:])
    return sums[0], sums[1]


def _span_sums(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    high, low = _reduced(sums[0][ends] - sums[0][starts]), _reduced(sums[1][ends] - sums[1][starts])
    return _reduced((high >> _S30) + ((high & _LOW30) << _S31) + low)


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[raw]


def folded(raw: np.ndarray) -> np.ndarray:
    """A-Z and the letters U+00C0 to U+00DE in lower case."""
    out = _LOWER[raw]
    if len(raw) > 1:
        second = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        out[1:][second] += 32
    return out


def word_spans(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without `space` bytes) and, per text, the number of the first word."""
    solid = ~space[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    edge[1:] |= ~solid
    starts = np.flatnonzero(solid & edge[:-1])
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    edge[:-1] |= ~solid
    ends = np.flatnonzero(solid & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def chained(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbouring word hashes."""
    out = words[: len(words) - k + 1] + np.uint64(k)
    for i in range(1, k):
        out = mixed(out) + words[i : len(words) - k + 1 + i]
    return mixed(out)


def document_shingles(words: np.ndarray, firsts: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per text, its shingle hashes in order: all k-word runs; with fewer words, the whole sequence as one; none without words."""
    runs = chained(words, k) if len(words) >= k else np.zeros(0, np.uint64)
    for a, b in zip(firsts[:-1], firsts[1:]):
        if b - a >= k:
            yield runs[a : b - k + 1]
        elif b > a:
            yield chained(words[a:b], int(b - a))
        else:
            yield runs[:0]


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Per row, the sorted distinct shingle hashes of the text with A-Z lower-cased."""
    for _, _, raw, offsets in text_blocks(texts):
        raw = lowered(raw)
        starts, ends, firsts = word_spans(raw, offsets)
        words = span_hashes(raw, starts, ends)
        for hashes in document_shingles(words, firsts, k):
            yield np.unique(hashes)
