from __future__ import annotations

import math
import re

import numpy as np
import pytest
from corpus_fixtures import awkward_documents, clashing, documents, prose
from pyspark.sql import functions as F

from reportloom.llm import jaccard_join, line_dedup, near_vectors
from reportloom.llm.graph import connected_components
from reportloom.llm.jaccard_join import jaccard_classes
from reportloom.llm.line_dedup import dedup_lines
from reportloom.llm.near_vectors import link_vectors

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts_of(nodes, links):
    """Smallest reachable node per node."""
    least = {n: n for n in nodes}
    while True:
        after = dict(least)
        for a, b in links:
            after[a] = after[b] = min(after[a], after[b])
        if after == least:
            return least
        least = after


def test_components_of_a_chain_a_star_and_noise(spark):
    links = [(i, i + 1) for i in range(1, 90)] + [(500, 500 + i) for i in range(1, 60)] + [(3, 3), (None, 4), (7, 8)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    want = parts_of([*range(1, 91), *range(500, 560)], [x for x in links if None not in x])
    assert {r.node: r.component for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# Line dedup


def plain_line_dedup(rows, least):
    keys = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if i is not None and len(key) >= least:
                keys.setdefault(key, set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        held = [keys.get(x.strip(" \t\n\x0b\x0c\r").translate(LOWER), set()) for x in lines]
        kept = [x for x, ids in zip(lines, held) if i is None or len(ids) < 2 or i == min(ids)]
        out.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("slice_bits", [line_dedup.SLICE_BITS, 5])
def test_line_dedup_against_plain_version(spark, monkeypatch, slice_bits):
    monkeypatch.setattr(line_dedup, "SLICE_BITS", slice_bits)  # tiny slices: many false suspects, same result
    rows = [(i, t) for i, t in awkward_documents()] + [(None, "A line that many share"), (21, "\xa0A line that many share")]
    rows += [(300 + i, f"every document says this\nown line number {i} here\n\n") for i in range(40)]
    got = dedup_lines(documents(spark, rows), 10).collect()
    assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in got) == plain_line_dedup(rows, 10)


def test_line_dedup_keeps_other_columns_and_repeated_rows(spark):
    docs = clashing(documents(spark, [(2, "the same long line"), (1, "the same long line\nx"), (2, "the same long line"), (3, None)]))
    out = dedup_lines(docs, 10)
    assert set(out.columns) == set(docs.columns)
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped, r.key, r.lang) for r in out.collect())
    assert got == [(1, "the same long line\nx", 2, 0, "x", "en"), (2, "", 1, 1, "x", "en"), (2, "", 1, 1, "x", "en"), (3, "", 1, 0, "x", "en")]
    # one id alone: its repeated rows are one document
    alone = dedup_lines(documents(spark, [(5, "only one id has this"), (5, "only one id has this")]), 10).collect()
    assert [r.n_dropped for r in alone] == [0, 0]
    assert dedup_lines(documents(spark, []), 10).count() == 0


# Jaccard join


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def plain_jaccard(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    least = parts_of(ids, links)
    return sorted((i, len(sets[i]), least[i]) for i in ids)


def edited(text, seed, n):
    rng, words = np.random.default_rng(seed), text.split()
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"edit{seed}x{at}"
    return " ".join(words)


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (2, 50), (1, 90)])
def test_jaccard_against_all_pairs(spark, k, percent):
    rows = awkward_documents() + [(None, "no id at all here"), (41, "ONE TWO"), (42, "one"), (43, "one"), (44, "one two three four")]
    for family in range(6):
        base = prose(900 + family, 90)
        rows += [(1000 + 50 * family + i, edited(base, 50 * family + i, i % 5)) for i in range(20)]
    rows += [(3000 + i, prose(700, 40) + " " + prose(800 + i, 12)) for i in range(20)]  # one passage in many documents
    got = jaccard_classes(clashing(documents(spark, rows)), k, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_jaccard(rows, k, percent)


def test_jaccard_without_families_uses_the_matrix_alone(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_grouped", lambda classes, families, pairs, make=jaccard_join._grouped: make(classes, families.limit(0), pairs))
    base = prose(77, 120)
    rows = [(i, edited(base, i, i % 4)) for i in range(25)] + awkward_documents()[:12]
    rows = [(i, t) for n, (i, t) in enumerate(rows) if i not in {j for j, _ in rows[:n]}]
    got = jaccard_classes(documents(spark, rows), 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_jaccard(rows, 4, 85)


def test_jaccard_of_repeated_ids_takes_the_longest_text(spark):
    rows = [(1, "a b c d e f"), (1, "x x x x x x x x"), (2, "x x x x x x x x"), (3, "a b c d e f"), (4, "a b c d e f g"), (4, "a b c d e f g")]
    got = jaccard_classes(documents(spark, rows), 4, 70).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 1, 1), (2, 1, 1), (3, 3, 3), (4, 4, 3)]


def test_jaccard_of_empty_and_repeated_rows(spark):
    assert jaccard_classes(documents(spark, []), 4, 85).count() == 0
    got = jaccard_classes(documents(spark, [(2, "a b c d e"), (2, "a b c d e"), (1, None), (3, "")]), 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 2, 2), (3, 0, 3)]


# Vectors


def plain_vectors(rows, limit):
    usable = [
        (i, np.array(v, float) / max(map(abs, v)), label)
        for i, v, label in rows
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = set()
    for a, u, x in usable:
        for b, v, y in usable:
            if a < b and x == y and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= limit:
                links.add((a, b))
    least = parts_of([r[0] for r in rows], links)
    return sorted((i, sum(i in x for x in links), least[i], least[i] == i) for i, _, _ in rows)


def vector_rows():
    rng = np.random.default_rng(2)
    rows = []
    for label in range(3):
        rows += [(1000 * label + i, rng.normal(size=16).round(3).tolist(), label) for i in range(120)]
        centre = rng.normal(size=16)
        # a large group of near copies, some pairs of which are just below the limit
        rows += [(1000 * label + 200 + i, (centre + rng.normal(size=16) * 0.22).round(3).tolist(), label) for i in range(90)]
        rows += [(1000 * label + 400 + i, [1.0] * 15 + [float(label)], label) for i in range(40)]
    rows += [(9001, None, 0), (9002, [0.0] * 16, 0), (9003, [float("nan")] * 16, 0), (9004, [None, *[1.0] * 15], 0), (9005, [], 0)]
    rows += [(9006, [1.0] * 16, None), (9007, [2.0] * 16, 0), (9008, [1e200] * 16, 0), (9009, [float("inf")] * 16, 0), (9010, [1.0, 2.0], 0), (9011, [2.0, 4.0], 0), (9012, [3.0], 1), (9013, [4.0], 1)]
    return rows


@pytest.mark.parametrize("block", [near_vectors.BLOCK, 20])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    rows = vector_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    table = table.withColumns({n: F.lit(1) for n in ("id", "v", "node", "filter", "copies", "links", "n_links", "dim")})
    got = sorted(tuple(r) for r in link_vectors(table, 0.93).collect())
    want = plain_vectors(rows, 0.93)
    assert [r[0] for r in got] == [r[0] for r in want]
    pairs = sum(r[1] for r in want)
    assert 0.98 * pairs <= sum(r[1] for r in got) <= pairs
    assert sum(a == b for a, b in zip(got, want)) >= 0.95 * len(want)


def test_vectors_empty_and_repeated(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert link_vectors(spark.createDataFrame([], schema), 0.93).count() == 0
    got = link_vectors(spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.1], 1)], schema), 0.93).collect()
    assert sorted((r.vec_id, r.component_id, r.kept) for r in got) == [(1, 1, True), (2, 1, False)]


@pytest.mark.parametrize("n", [500, 5000])
def test_recall_of_the_filters_at_the_limit(n):
    size = max(4, math.ceil(math.sqrt(n * near_vectors.FILTERS_PER_VECTOR / near_vectors.BUCKET)))
    rng = np.random.default_rng(0)
    x, z = rng.standard_normal((2, 1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    shared = [len(np.intersect1d(a, b)) > 0 for a, b in zip(near_vectors.decode(x, size), near_vectors.decode(y, size))]
    assert np.mean(shared) >= 0.99


def test_no_table_is_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    jaccard_classes(documents(spark), 5, 80).count()
    assert {t.name for t in spark.catalog.listTables()} == before
