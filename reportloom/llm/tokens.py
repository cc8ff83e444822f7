"""Token ids exactly as the tokenizers library gives them, with each distinct piece of text encoded once per worker.

A text is cut where no token of the tokenizer can span the cut ("safe boundaries"); the ids of the text are
the ids of its pieces in order. Pieces repeat a lot, so a fixed-size table per Python worker remembers their
ids. Texts that hold one of the tokenizer's added tokens, and tokenizers with an unknown pre-tokenizer, are
encoded whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .hashing import lowered, span_hashes, text_blocks

SLOTS = 1 << 21  # entries of a worker's table
LONG_BYTES = 8 << 20  # a longer text is looked up in parts
FLAT_IDS = 12_000_000  # remembered ids before the table starts afresh

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)  # printable ASCII that is neither letter nor digit nor space
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[33:127] = True
# Patterns that must be known for the cuts to be right (fixed values of the two public tokenizers).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """Encodes Arrow text columns; one per worker and file, see `encoder`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.cut = self._kind(spec)
        self._forget()

    @staticmethod
    def _kind(spec: dict) -> str:
        """"space": white space ends a piece and is dropped; "lead": a single space starts a piece; "": no cuts."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return "lead"
        parts = pre.get("pretokenizers") or [{}]
        if (
            parts[0].get("type") == "Split"
            and parts[0].get("invert")
            and parts[0].get("behavior") == "Removed"
            and parts[0].get("pattern", {}).get("Regex") == WORD_PATTERN
            and [n.get("type") for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        ):
            return "space"
        return ""

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.slot_start, self.slot_size = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _remember(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(sizes.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(total, self.used), np.uint32)])
        at = self.used
        self.flat[at : at + total] = np.fromiter((i for ids in lists for i in ids), np.uint32, total)
        self.used += total
        return at + np.cumsum(sizes) - sizes, sizes

    def _pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces; every byte that can make a token is in one of them, and none spans two texts."""
        n = len(raw)
        begin = np.zeros(n + 1, bool)
        begin[offsets] = True
        latin = np.zeros(n, bool)  # last bytes of the letters U+00C0 to U+00FF
        latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        begin[1:n] |= (_LETTER[raw[:-1]] | latin[:-1]) & _MARK[raw[1:]]
        if self.cut == "space":
            blank = (raw == 0x20) | (raw == 0x0A)
            begin[:-1] |= blank
            begin[1:] |= blank
            starts = np.flatnonzero(begin[:-1])
            ends = np.append(starts[1:], n)
            keep = ~blank[starts] if n else np.zeros(0, bool)
            return starts[keep], ends[keep]
        before = _PLAIN[raw] | latin
        after = _PLAIN[raw] | (raw == 0xC3)
        if n > 2:
            begin[1 : n - 1] |= (raw[1:-1] == 0x20) & before[:-2] & after[2:]
        starts = np.flatnonzero(begin[:-1])
        return starts, np.append(starts[1:], n)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, all ids, row offsets into the ids) for consecutive rows; null counts as empty."""
        for first, end, raw, offsets in text_blocks(texts):
            data = raw.tobytes()
            if not self.cut or any(token in data for token in self.added):
                for row in range(first, end):
                    one = data[offsets[row - first] : offsets[row - first + 1]]
                    if self.cut and not any(token in one for token in self.added):
                        yield row, row + 1, *self._cut_up(np.frombuffer(one, np.uint8), np.array([0, len(one)]), one)
                    else:
                        ids = np.array(self._encode([one.decode()])[0], np.uint32)
                        yield row, row + 1, ids, np.array([0, len(ids)])
            else:
                yield first, end, *self._cut_up(raw, offsets, data)

    def _cut_up(self, raw: np.ndarray, offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        if len(raw) <= LONG_BYTES:
            return self._look_up(raw, offsets, data)
        parts, at = [], 0  # one very long text: its parts end at safe cuts, so that work space stays small
        while at < len(raw):
            window = raw[at : at + LONG_BYTES]
            end = len(raw) - at
            if end > len(window):
                starts, _ = self._pieces(window, np.array([0, len(window)]))
                cuts = starts[(starts > 0) & (starts < len(window) - 4)]
                end = int(cuts[-1]) if len(cuts) else end
            part = raw[at : at + end]
            parts.append(self._look_up(part, np.array([0, len(part)]), data[at : at + end])[0])
            at += end
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])

    def _look_up(self, raw: np.ndarray, offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = self._pieces(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        # Case is folded for the table where the tokenizer folds it anyway and no combining mark (U+0300 on) is near.
        fold = self.cut == "space" and int(raw.max()) < 0xCC
        hashes = span_hashes(lowered(raw) if fold else raw, starts, ends)
        if self.used > FLAT_IDS:
            self._forget()
        slots = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        missing = np.flatnonzero(self.keys[slots] != hashes)
        at, sizes = self.slot_start[slots], self.slot_size[slots]
        if len(missing):
            _, where, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            new = missing[where]
            found, size = self._remember(
                self._encode([data[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            )
            at[missing], sizes[missing] = found[back], size[back]
            taken = slots[new]
            self.keys[taken], self.slot_start[taken], self.slot_size[taken] = hashes[new], found, size
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(at - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(starts, offsets)]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a vocabulary file; it stays for the tasks that the worker runs later."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
