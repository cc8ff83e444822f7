"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import awkward_documents, clashing, documents, prose
from pyspark.sql import functions as F

from reportloom.llm import resampling
from reportloom.llm.resampling import drawn_documents, importance_resample, ngram_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, longest):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_resample(rows, wanted, percent, least, longest, buckets):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    have, want = np.zeros(buckets), np.zeros(buckets)
    for _, text in rows:
        for f in features(text, longest):
            have[bucket(f)] += 1
    for text in wanted:
        for f in features(text, longest):
            want[bucket(f)] += 1
    s_all, t_all = have.sum(), want.sum()
    gains = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(have, want)]
    out = []
    for i, text in rows:
        found = features(text, longest)
        weight = sum(gains[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(features(text, 1))])
    large = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = [None] * len(large)
    ranks[: len(large) * percent // 100] = range(1, len(large) * percent // 100 + 1)
    drawn = [(*r[:4], rank) for r, rank in zip(large, ranks)]
    return drawn + [(*r[:4], None) for r in out if r[4] < least]


def result(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
@pytest.mark.parametrize("block_bytes", [resampling.BLOCK_BYTES, 7])
def test_ngrams_of_a_batch_stay_inside_their_texts(longest, block_bytes, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block_bytes)
    texts = ["One two  three", None, "", "x", "four-FIVE\nsix seven É", " \x00 ", "x y z " * 20, "İ ẞ ab12\x7fcd"]
    for column in (pa.array(texts), pa.chunked_array([texts[:3], texts[3:]]), pa.array(["skipped", *texts]).slice(1)):
        got = sorted((n, int(r), int(c)) for n, rows, crcs in ngram_hashes(column, longest) for r, c in zip(rows, crcs))
        want = sorted((f.count(" ") + 1, r, zlib.crc32(f.encode())) for r, t in enumerate(texts) for f in features(t, longest))
        assert got == want
    assert list(ngram_hashes(pa.array([], pa.string()), longest)) == []


@pytest.mark.parametrize("longest, percent", [(1, 10), (2, 35)])
def test_resampling_against_a_plain_version(spark, longest, percent):
    rows = awkward_documents() + [(None, prose(31, 40)), (9, prose(32, 50)), (9, prose(32, 50))]
    wanted = [prose(50, 30), "amber birch fjord " * 9, None, ""]
    target = spark.createDataFrame([(t,) for t in wanted], "text string")
    docs = clashing(documents(spark, rows)).withColumns({c: F.lit("x") for c in ("weight", "rank", "draw", "place", "n", "n_features")})
    got = importance_resample(docs, target, percent, 20, longest, 500)
    assert got.columns == ["doc_id", "n_features", "n_words", "weight", "score", "rank"]
    want = plain_resample(rows, wanted, percent, 20, longest, 500)
    assert result(got) == sorted(want, key=str)
    drawn = {i for i, *_, rank in want if rank is not None and i is not None}
    texts = drawn_documents(documents(spark, rows), got)
    assert {r.doc_id for r in texts.collect()} == drawn and texts.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_resampling_of_empty_tables(spark):
    nothing = spark.createDataFrame([], "text string")
    assert importance_resample(documents(spark, []), nothing).count() == 0
    rows = [(i, prose(i, 25)) for i in range(25)]
    assert result(importance_resample(documents(spark, rows), nothing)) == sorted(plain_resample(rows, [], 10, 20, 1, 10_000), key=str)


def test_resampling_prefers_the_target(spark):
    rows = [(i, prose(i, 60) if i % 4 else "benchmark question answer " * 20) for i in range(200)]
    target = spark.createDataFrame([("benchmark question answer",)] * 30, "text string")
    drawn = {r.doc_id for r in importance_resample(documents(spark, rows), target, 20).where("rank is not null").collect()}
    assert len(drawn) == 40 and all(i % 4 == 0 for i in drawn)
