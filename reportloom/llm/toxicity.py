"""Toxicity of whole texts: noisy-channel restoration of disguised words, then a learned word list.

Disguised words are written with digits and signs for letters, with letters set apart, or with letters
repeated. Such a word is a lattice of possible letters; the path that a character model of the corpus finds
most likely is the restored word (Viterbi).
"""

from __future__ import annotations

import itertools
import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .counting import summed_counts
from .hashing import NOT_IN_WORD, folded, mixed, span_hashes, text_blocks, word_spans
from .storage import batches_by_bytes, stored

# Which letters a sign may stand for (fixed values).
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il",
}
SIGN_COST = math.log(4)  # of reading a sign as a letter
DROP_COST = math.log(20)  # of dropping one of just two equal letters
LETTERS = 59  # a-z, U+00E0 to U+00FF, and 0 for everything between words
PREFIX_BYTES = (4, 5)  # words of more bytes also count by these beginnings
LEAST_SHARE = 0.9  # share of a listed word's texts that have label 1
CAUTION = 3.0  # standard errors by which the share of a word's texts with label 1 is lowered
REMEMBERED = 64  # characters of the words whose reading is remembered
MARKS = "!|$@"  # signs that may be punctuation as well
TAIL = MARKS + "0123456789"  # what a disguised word may end with, read as letters or dropped

_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_@$!|][ .\-_*]|[@$!|][ .\-_*]){3,}(?:[^\W_]|[@$!|])(?![^\W_])")
_WORD = re.compile(r"[\w@$!|]{2,}")
_DISGUISED = re.compile(r"[^\W\d_][0134578 9@$!|]+[^\W\d_]|^[0134578 9@$!|]+[^\W\d_]{2}|[^\W\d_][0-9@$!|]+$|([^\W\d_])\1\1")
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in SIGNS]] = True
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in TAIL]] = True
_NOT_IN_RUN = NOT_IN_WORD.copy()  # as in _SPACED, signs count as letters
_NOT_IN_RUN[[ord(c) for c in MARKS]] = False


# Character model


def symbols(raw: np.ndarray) -> np.ndarray:
    """Folded bytes as symbols of the character model."""
    out = _SYMBOL[raw]
    if len(raw) > 1:
        second = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0xA0) & (raw[1:] <= 0xBF)) + 1
        out[second] = 27 + (raw[second] - 0xA0)
        keep = np.ones(len(raw), bool)
        keep[second - 1] = False
        out = out[keep]
    return out


def trigram_counts(texts: pa.Array) -> np.ndarray:
    total = np.zeros(LETTERS**3, np.int64)
    for _, _, raw, _ in text_blocks(texts):
        s = np.concatenate([[0, 0], symbols(folded(raw)), [0]])
        total += np.bincount((s[:-2] * LETTERS + s[1:-1]) * LETTERS + s[2:], minlength=LETTERS**3)
    return total


def character_model(texts: DataFrame) -> np.ndarray:
    """log P(letter | two letters before) from all texts, backed by the letter's own frequency."""
    counts = summed_counts(texts, lambda batch: trigram_counts(batch.column(0)), LETTERS**3)
    counts = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
    single = (counts.sum((0, 1)) + 1) / (counts.sum() + LETTERS)
    pairs = (counts.sum(0) + LETTERS * single) / (counts.sum((0, 2))[:, None] + LETTERS)
    model = (counts + 20 * pairs[None]) / (counts.sum(2, keepdims=True) + 20)
    return np.log(model).astype(np.float32)


# Restoration


class Restorer:
    """Restores the disguised words of texts; remembers the words it has seen."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[str, str] = {}

    def text(self, text: str) -> str:
        """The text in lower case with disguised words restored."""
        text = _SPACED.sub(lambda m: self.run(m[0]), text.lower())
        return _WORD.sub(lambda m: self.word(m[0]), text)

    def run(self, spaced: str) -> str:
        """Letters that stood apart, as the likeliest words, and once more as one word (or one beside a word of one letter)."""
        letters = re.sub(r"[ .\-_*]", "", spaced)
        if not re.search(r"[^\W\d_]", letters):
            return spaced
        whole, first, last = (self._decode(x) if _disguised(x) else x for x in (letters, letters[1:], letters[:-1]))
        joined = max(whole, f"{letters[0]} {first}", f"{last} {letters[-1]}", key=self.likelihood)
        ends = dict.fromkeys([letters, letters.rstrip(MARKS), letters.rstrip(TAIL)])
        return " ".join(dict.fromkeys([*(self._decode(x, True) for x in ends), joined]))

    def likelihood(self, text: str) -> float:
        padded = [0, 0, *map(_symbol, text), 0]
        return sum(self.model[a][b][c] for a, b, c in zip(padded, padded[1:], padded[2:]))

    def word(self, word: str) -> str:
        if len(word) > REMEMBERED:
            return self._readings(word) if _disguised(word) else word
        if len(self.known) > 200_000:
            self.known.clear()
        if word not in self.known:
            self.known[word] = self._readings(word) if _disguised(word) else word
        return self.known[word]

    def _readings(self, word: str) -> str:
        """All distinct readings: with the signs at the ends as letters, without them, and of the parts between marks."""
        forms = [word, word.rstrip("!"), word.rstrip(MARKS), word.rstrip(TAIL)]
        forms += [form.lstrip(MARKS) for form in forms]
        forms += [part for part in re.split(r"[!|$@_]+", word) if len(part) > 2]
        return " ".join(dict.fromkeys(self._decode(form) if _disguised(form) else form for form in dict.fromkeys(forms) if form))

    def _decode(self, word: str, spaced: bool = False) -> str:
        """The likeliest letters. A run of equal letters is read as one or two of them.

        Of letters that stood apart, a word may end after each. Two equal ones stay two, if nothing else is disguised.
        """
        exact = spaced and not _disguised(word)
        columns: list[list[tuple[str, float]]] = []
        for char, run in itertools.groupby(word):
            n = len(list(run))
            letters = SIGNS.get(char, "") if not char.isalpha() else char
            reading = [(x, -SIGN_COST * (not char.isalpha())) for x in letters] or [("", 0.0)]
            if n > 1:
                once = [] if exact and n == 2 else [(x, cost - DROP_COST * (n == 2)) for x, cost in reading]
                apart = [(x + " " + x, 2 * cost) for x, cost in reading if x and spaced]
                if spaced and n > 2:
                    apart += [(y, 3 * cost) for x, cost in reading if x for y in (2 * x + " " + x, x + " " + 2 * x)]
                reading = [*once, *((2 * x, 2 * cost) for x, cost in reading), *apart]
            if spaced and columns:
                reading += [(" " + x, cost) for x, cost in reading if x]
            columns.append(reading)
        # state: the last two symbols; value: log probability and the letters so far, as a chain
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for column in columns:
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in states.items():
                for letters, cost in column:
                    x, y, total = a, b, score + cost
                    for letter in letters:
                        s = _symbol(letter)
                        total += self.model[x][y][s]
                        x, y = y, s
                    if (x, y) not in after or after[x, y][0] < total:
                        after[x, y] = total, (path, letters)
            states = after
        path, out = max((score + self.model[a][b][0], i, path) for i, ((a, b), (score, path)) in enumerate(states.items()))[2], []
        while path:
            path, letters = path
            out.append(letters)
        return "".join(reversed(out))


def _symbol(letter: str) -> int:
    code = ord(letter)
    return code - 96 if 97 <= code <= 122 else code - 0xE0 + 27 if 0xE0 <= code <= 0xFF else 0


def _disguised(word: str) -> bool:
    """Signs between letters, before letters or behind them, or a letter three times in a row."""
    return bool(_DISGUISED.search(word)) or (word[:1] in tuple(MARKS) and len(word.strip(MARKS)) > 2)


def suspicious_rows(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts of a block (folded bytes) may hold a disguised word."""
    letter, sign, tail = _LETTER[raw], _SIGN[raw], _TAIL[raw]
    hit = np.zeros(len(raw) + 1, bool)
    if len(raw) > 1:
        hit[: len(raw) - 1] |= (sign[:-1] & letter[1:]) | (letter[:-1] & tail[1:])
    if len(raw) > 2:
        hit[: len(raw) - 2] |= letter[2:] & (raw[:-2] == raw[1:-1]) & (raw[1:-1] == raw[2:])
    for size in (2, 3, 4):  # bytes of a letter beyond ASCII that comes three times
        if len(raw) >= 3 * size:
            again = np.concatenate([[0], np.cumsum(raw[size:] == raw[:-size])])
            hit[: len(again) - 2 * size] |= (raw[: len(again) - 2 * size] >= 0xC2) & (again[2 * size :] - again[: -2 * size] == 2 * size)
    starts, ends, _ = word_spans(raw, offsets, _NOT_IN_RUN)
    if len(starts) > 3:
        lone = (ends - starts == 1) | ((ends - starts == 2) & (raw[starts] >= 0xC2))
        near = np.append((starts[1:] - ends[:-1]) == 1, False)
        run = lone[:-2] & lone[1:-1] & lone[2:] & near[:-2] & near[1:-1]
        hit[starts[:-2][run]] = True
    return np.diff(np.concatenate([[0], np.cumsum(hit)])[np.append(offsets[:-1], len(raw))]) > 0


# Words


def restored_words(texts: pa.Array, restorer: Restorer) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """(first row, end row, hashes of the words and of their beginnings (0: none), first word of each row) per block."""
    for first, end, raw, offsets in text_blocks(texts):
        raw = folded(raw)
        odd = np.flatnonzero(suspicious_rows(raw, offsets))
        if len(odd):
            data = raw.tobytes()
            parts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            for row in odd:
                parts[row] = restorer.text(parts[row].decode()).encode()
            raw = folded(np.frombuffer(b"".join(parts), np.uint8))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        starts, ends, firsts = word_spans(raw, offsets, NOT_IN_WORD)
        features = [span_hashes(raw, starts, ends)]
        for size in PREFIX_BYTES:
            long = ends - starts > size
            heads = np.zeros(len(starts), np.uint64)
            heads[long] = mixed(span_hashes(raw, starts[long], starts[long] + size) ^ np.uint64(0xA5A5))
            features.append(heads)
        yield first, end, features, firsts


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    learn_from: str = "true",
    keep: list[str] | None = None,
) -> DataFrame:
    """`keep` (default: id), score and predicted per row of `docs`; score is 0 to 1, predicted is 1 from 0.5 on.

    1. The character model counts the trigrams of all texts.
    2. About `max_labelled` labelled documents (by a hash of the id; all, if there are fewer) give the word
       list: after restoration, each word and each word's beginning with the number of texts of either label.
       Words are listed whose share of texts with label 1 is LEAST_SHARE or more, and one half or more at the
       lower end of its confidence interval; their weight is the log odds of that share less those of the base rate. The list is
       bounded by that sample, not by the corpus. `learn_from` is a SQL condition on the id column
       and limits which labels may be used.
    3. Each whole text is restored, and the weights of its distinct listed words are added to the base rate's
       log odds.

    Null and empty texts get the base rate. Null ids are scored but never learnt from; repeated rows are
    scored alike; labels other than 0 and 1, and ids with both labels, are not used. Empty tables give an
    empty one; without labels every score is that of a base rate of one half. Only the named columns are read.
    """
    batches_by_bytes(docs)
    spark = docs.sparkSession
    rows = docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"))
    model = spark.sparkContext.broadcast(character_model(rows.select("text")))
    known = labels.where(learn_from).select(labels[id].alias("id"), labels[label].cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
    known = known.where("label = top").drop("top")
    n_known = known.count()
    spread = 1 << 30
    chosen = F.pmod(F.xxhash64("id"), F.lit(spread)) < min(spread, spread * max_labelled // max(1, n_known))
    sample = rows.where(chosen).join(known.where(chosen), "id").groupBy(F.xxhash64("text"), "label").agg(F.first("text").alias("text"))
    sample = stored(sample.select("text", "label"), "labelled-texts")
    base = sample.agg(F.count_if(F.col("label") == 1).alias("one"), F.count_if(F.col("label") == 0).alias("zero")).first()
    listed = _word_list(sample, model, base["one"], base["zero"])
    shared = spark.sparkContext.broadcast((*listed, math.log((base["one"] + 1) / (base["zero"] + 1))))
    kept = [c for c in (keep or [id]) if c not in ("score", "predicted")]
    source = docs.select(*[docs[c] for c in kept], docs[text].cast("string").alias("__text"))
    schema = StructType([*(docs.schema[c] for c in kept), StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return source.mapInArrow(_scores(model, shared), schema)


def _word_list(sample: DataFrame, model: Broadcast, ones: int, zeros: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and weights of the words that speak for label 1."""
    token = uuid.uuid4().hex

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(token, model)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            found: dict[int, list[np.ndarray]] = {0: [], 1: []}
            for first, end, features, firsts in restored_words(batch.column(0), restorer):
                for row in range(first, end):
                    span = slice(firsts[row - first], firsts[row - first + 1])
                    found[int(label[row])].append(np.unique(np.concatenate([f[span] for f in features])))
            for value, sets in found.items():
                if sets:
                    hashes, n = np.unique(np.concatenate(sets), return_counts=True)
                    n = n[hashes != 0]
                    hashes = hashes[hashes != 0]
                    zero = np.zeros(len(n), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes.view(np.int64)), pa.array(n if value else zero), pa.array(zero if value else n)],
                        ["hash", "ones", "zeros"],
                    )

    words = sample.mapInArrow(counts, "hash long, ones long, zeros long").groupBy("hash")
    n, z2 = F.col("ones") + F.col("zeros"), CAUTION**2
    share = F.col("ones") / n
    low = (share + z2 / (2 * n) - CAUTION * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    words = words.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).where(share >= LEAST_SHARE).select("hash", low.alias("low"))
    weight = F.log(F.col("low") / (1 - F.col("low"))) - math.log((ones + 1) / (zeros + 1))
    listed = words.where("low >= 0.5").select("hash", weight.alias("weight")).toPandas()
    order = np.argsort(listed["hash"].to_numpy().view(np.uint64))
    return listed["hash"].to_numpy().view(np.uint64)[order], listed["weight"].to_numpy(float)[order]


_restorers: dict[str, Restorer] = {}


def _restorer(token: str, model: Broadcast) -> Restorer:
    """The worker's restorer for one model."""
    if token not in _restorers:
        _restorers.clear()
        _restorers[token] = Restorer(model.value)
    return _restorers[token]


def _scores(model: Broadcast, shared: Broadcast):
    token = uuid.uuid4().hex
    bits = np.uint64((1 << 20) - 1)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, (listed, weights, base) = _restorer(token, model), shared.value
        maybe = np.zeros(int(bits) + 1, bool)
        maybe[(listed & bits).astype(np.int64)] = True
        for batch in batches:
            logit = np.full(batch.num_rows, base)
            for first, _, features, firsts in restored_words(batch.column(batch.num_columns - 1), restorer):
                for hashes in features:
                    at = np.flatnonzero(maybe[(hashes & bits).astype(np.int64)])
                    place = np.searchsorted(listed, hashes[at])
                    place[place == len(listed)] = 0
                    right = listed[place] == hashes[at] if len(listed) else np.zeros(0, bool)
                    row = np.searchsorted(firsts, at[right], "right") - 1
                    pairs = np.unique(row.astype(np.int64) * (len(listed) + 1) + place[right])
                    np.add.at(logit, first + pairs // (len(listed) + 1), weights[pairs % (len(listed) + 1)])
            score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                [*batch.schema.names[:-1], "score", "predicted"],
            )

    return scores
