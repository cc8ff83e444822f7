from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from reportloom.operators import clustering, retrieval
from reportloom.operators.arrays import runs_of
from reportloom.operators.weighted_chunks import cited_chunks, term_weights, weighted_vectors


def brute_top(vectors, queries, k):
    out = {}
    for q, qv in queries.items():
        scored = []
        for i, v in vectors.items():
            norm = np.linalg.norm(v) * np.linalg.norm(qv)
            scored.append((-round(float(np.dot(v, qv) / norm), 9) if norm else 0.0, i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("block_queries", [100, 3])
def test_retrieve_against_brute_force(spark, block_queries):
    rng = np.random.default_rng(1)
    vectors = {i: rng.normal(size=8).round(3) for i in range(150)}
    vectors.update({i: vectors[7] for i in range(150, 220)})  # a third of all rows are copies
    vectors[220] = np.zeros(8)
    queries = {q: rng.normal(size=8).round(3) for q in range(9)} | {9: vectors[7]}
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "id int, embedding array<double>").repartition(5)
    asked = spark.createDataFrame([(q, [float(x) for x in v]) for q, v in queries.items()], "query_id int, embedding array<double>")
    table = table.union(spark.createDataFrame([(999, None)], table.schema))
    asked = asked.union(spark.createDataFrame([(99, None)], asked.schema))
    rows = retrieval.retrieve(table, asked, 6, ["id"], block_queries=block_queries, block_rows=40).orderBy("query_id", "rank").collect()
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append(r.id)
    assert got == brute_top(vectors, queries, 6)


def test_retrieve_without_questions(spark):
    table = spark.createDataFrame([(1, [1.0])], "id int, embedding array<double>")
    none = spark.createDataFrame([], "query_id int, embedding array<double>")
    assert retrieval.retrieve(table, none, 3, ["id"]).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 6, 9, 10, 11, 23])
def test_chunks_cover_the_whole_text(spark, n):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(1, " " + " \n ".join(words))], "id int, t string")
    rows = [r.chunk.split(" ") for r in retrieval.chunks(df, "id", "t", size=6, overlap=2).orderBy("chunk_no").collect()]
    assert (rows == []) == (n == 0)
    joined = [w for i, row in enumerate(rows) for w in (row if i == 0 else row[2:])]
    assert joined == words and all(len(r) == 6 for r in rows[:-1]) and all(len(r) > 2 for r in rows[1:])


def test_encoded_counts(spark):
    df = spark.createDataFrame([(1, "a b A"), (2, "c"), (3, None)], "id int, t string")
    got = {r.id: r.v for r in df.select("id", retrieval.encode("t", 16).alias("v")).collect()}
    assert sum(got[1]) == 3.0 and max(got[1]) >= 2.0 and sum(got[2]) == 1.0 and len(got[3]) == 16 and sum(got[3]) == 0.0



def test_chunks_name_the_sections_they_touch(spark):
    lines = ["one two", "", "three   four\tfive", "  ", "six seven eight nine ten", "eleven"]
    rows = [(1, "\n".join(lines)), (2, " \n\t"), (3, None), (4, "word")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = cited_chunks(df, "id", "t", size=4, overlap=1)
    plain = retrieval.chunks(df, "id", "t", size=4, overlap=1)
    found = sorted(tuple(r) for r in got.collect())
    assert [r[:3] for r in found] == sorted(tuple(r) for r in plain.collect() if r["chunk"].strip())
    section = {w: i for i, line in enumerate(lines) for w in line.split()} | {"word": 0}
    assert [(r[3], r[4]) for r in found] == [(section[r[2].split()[0]], section[r[2].split()[-1]]) for r in found]
    assert "Exchange" not in plan_of(got)


def test_weighted_vectors(spark):
    chunks = spark.createDataFrame([(0, "a b a"), (1, "a c"), (2, "a")], "id int, chunk string")
    weights = {r["term"]: (r["n_chunks"], r["weight"]) for r in term_weights(chunks).collect()}
    assert {t: n for t, (n, _) in weights.items()} == {"a": 3, "b": 1, "c": 1}
    assert weights["a"][1] == pytest.approx(1) and weights["b"][1] == pytest.approx(math.log(4 / 2) + 1)
    table = spark.createDataFrame([(t, w) for t, (_, w) in weights.items()], "term string, weight double")
    texts = spark.createDataFrame([(0, "a b a"), (7, "unknown A")], "id int, chunk string")
    got = {r["id"]: r["embedding"] for r in weighted_vectors(texts, ["id"], "chunk", table, 3, dim=64).collect()}
    slot = {r["w"]: r["s"][0] for r in spark.createDataFrame([(w,) for w in ("a", "b", "unknown")], "w string").select("w", retrieval.term_slots("w", 64).alias("s")).collect()}
    want = [0.0] * 64
    for word, weight in (("a", 2.0), ("b", math.log(2) + 1)):
        want[slot[word]] += weight
    assert got[0] == pytest.approx(want)
    assert sum(got[7]) == pytest.approx(1 + math.log(4) + 1) and len(got[7]) == 64


@pytest.mark.parametrize("labels", [1, 2, 4])
def test_silhouette_against_all_pairs(spark, labels):
    rng = np.random.default_rng(4)
    points = rng.normal([1e6, -3], 2, (80, 2))
    label = rng.integers(0, labels, 80)
    label[0] = 99 if labels > 1 else 0  # a cluster of one point
    df = spark.createDataFrame([(float(x), float(y), int(c)) for (x, y), c in zip(points, label)] + [(None, 1.0, 0), (1.0, 1.0, None)], "x double, y double, c int")
    away = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    values = []
    for i in range(80):
        own = (label == label[i]) & (np.arange(80) != i)
        means = [away[i, label == c].mean() for c in set(label.tolist()) - {label[i]}]
        a = away[i, own].mean() if own.any() else None
        values.append(None if not means else 0.0 if a is None else (min(means) - a) / max(min(means), a))
    got = clustering.silhouette(df, "x", "y", "c").first()
    assert got.n == 80
    assert got.silhouette is None if labels == 1 else got.silhouette == pytest.approx(np.mean(values), abs=1e-7)


def test_kmeans_cost_falls_with_k(spark):
    rng = np.random.default_rng(2)
    points = [(float(x), float(y)) for c in ((0, 0), (10, 0), (0, 10)) for x, y in rng.normal(c, 0.3, (40, 2))]
    df = spark.createDataFrame(points + [(None, 1.0)], "x double, y double")
    sweep = clustering.kmeans_sweep(df, "x", "y", [1, 2, 3, 5]).collect()
    quality = {r.k: r.silhouette for r in sweep}
    assert quality[1] is None and max((2, 3, 5), key=quality.get) == 3 and quality[3] > 0.95
    costs = {r.k: r.cost for r in sweep}
    assert costs[1] > costs[2] > costs[3]
    assert costs[1] == pytest.approx(((np.array(points) - np.array(points).mean(axis=0)) ** 2).sum())
    rows, centres, _ = clustering.kmeans(df, "x", "y", 3)
    assert sorted(r["count"] for r in rows.groupBy("cluster").count().collect()) == [40, 40, 40] and len(centres) == 3
    with pytest.raises(ValueError):
        clustering.kmeans(df, "x", "y", 10)


def test_words_are_counted_within_their_text(spark):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, None), (4, [None, "x", None])]
    got = spark.createDataFrame(rows, "i int, w array<string>").select("i", runs_of(F.col("w")).alias("r")).collect()
    assert {r.i: r.r for r in got} == {1: [["a"], ["b", "b"]], 2: [], 3: None, 4: [[None, None], ["x"]]}
    texts = spark.createDataFrame([(0, "a b a")], "id int, chunk string")
    weights = spark.createDataFrame([("a", 1.0)], "term string, weight double")
    plan = plan_of(weighted_vectors(texts, ["id"], "chunk", weights, 1))
    assert "collect_list" not in plan and plan.count("hashpartitioning(id") == 1


def test_points_of_one_file_are_spread(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 17), float(i % 5)) for i in range(400)] + [(None, 1.0)], "x double, y double").coalesce(1)
    assert clustering._spread(df, "x", "y").rdd.getNumPartitions() == 1
    monkeypatch.setattr(clustering, "TASK_POINTS", 100)
    spread = clustering._spread(df, "x", "y")
    assert spread.rdd.getNumPartitions() == 4 and spread.count() == 401
    monkeypatch.setattr(clustering, "MOST_POINTS", 20)
    monkeypatch.setattr(clustering, "TASK_POINTS", 10)
    assert clustering._spread(df, "x", "y").rdd.getNumPartitions() == 20
