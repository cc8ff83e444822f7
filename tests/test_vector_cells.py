"""Cells of vectors: the rows of an exhaustive search, from few cells."""

from __future__ import annotations

import numpy as np
import pytest

from reportloom.operators import vector_cells
from reportloom.operators.retrieval import retrieve
from reportloom.operators.vector_cells import cells_to_open, read_cells, retrieve_from_cells, write_cells

SCHEMA = "doc long, part int, embedding array<float>"


def clustered(n=3000, dim=16, groups=40, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return centres[rng.integers(0, groups, n)] + rng.normal(scale=0.15, size=(n, dim)), centres


def frame(spark, vectors, schema=SCHEMA):
    rows = [(i // 2, i % 2, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, schema).repartition(6)


def asked(spark, vectors):
    rows = [(f"q{i}", None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "query_id string, embedding array<double>")


def rows(df):
    return sorted((r["query_id"], r["rank"], r["doc"], r["part"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("k, blocks", [(1, (4096, 20000)), (5, (2, 50)), (40, (4096, 20000))])
def test_same_rows_as_an_exhaustive_search(spark, tmp_path, k, blocks):
    vectors, centres = clustered()
    vectors = list(vectors) + [vectors[7]] * 400 + [np.zeros(16)] * 3 + [None]  # one vector many times, none, no direction
    queries = list(centres[:6] + 0.05) + [np.zeros(16), -centres[0], vectors[7], None]
    table, questions = frame(spark, vectors), asked(spark, queries)
    write_cells(table, str(tmp_path / "c"), ["doc", "part"], cells=32)
    got = retrieve_from_cells(spark, str(tmp_path / "c"), questions, k, ["doc", "part"], block_queries=blocks[0], block_rows=blocks[1])
    want = retrieve(table, questions, k, ["doc", "part"])
    assert rows(got) == rows(want) and got.columns == want.columns


def test_random_vectors_and_fewer_rows_than_asked_for(spark, tmp_path):
    rng = np.random.default_rng(5)
    table, questions = frame(spark, rng.normal(size=(60, 8))), asked(spark, rng.normal(size=(7, 8)))
    for cells, k in ((1, 3), (8, 3), (8, 100)):
        write_cells(table, str(tmp_path / "c"), ["doc", "part"], cells=cells)
        got = retrieve_from_cells(spark, str(tmp_path / "c"), questions, k, ["doc", "part"])
        assert rows(got) == rows(retrieve(table, questions, k, ["doc", "part"]))


def test_few_cells_are_opened(spark, tmp_path):
    vectors, centres = clustered(4000, 24, 50)
    path = str(tmp_path / "c")
    write_cells(frame(spark, vectors), path, ["doc", "part"], cells=64)
    cells = read_cells(spark, path)
    assert sum(c["n"] for c in cells) == 4000 and all(-1 <= c["least_cosine"] <= 1 for c in cells)
    questions = asked(spark, centres)
    first = cells_to_open(questions, cells, 5, "embedding").groupBy("query_id").count().collect()
    best = retrieve_from_cells(spark, path, questions, 5, ["doc", "part"]).filter("rank = 5").selectExpr("query_id", "score as least")
    more = cells_to_open(questions.join(best, "query_id"), cells, 5, "embedding", "least").count()
    opened = sum(r["count"] for r in first) + more
    assert opened < 0.15 * len(cells) * len(centres)


def test_long_vectors_mean_fewer_cells(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_cells, "CENTRE_BYTES", 5 * 8 * 16)
    monkeypatch.setattr(vector_cells, "SAMPLE_BYTES", 9 * 8 * 16)
    vectors, centres = clustered(300)
    table, questions = frame(spark, vectors), asked(spark, centres[:3])
    write_cells(table, str(tmp_path / "c"), ["doc", "part"], cells=64)
    assert len(read_cells(spark, str(tmp_path / "c"))) <= 5
    got = retrieve_from_cells(spark, str(tmp_path / "c"), questions, 4, ["doc", "part"])
    assert rows(got) == rows(retrieve(table, questions, 4, ["doc", "part"]))


def test_bounds_hold_for_every_vector(spark, tmp_path):
    vectors, centres = clustered(1500, 12, 20)
    path = str(tmp_path / "c")
    write_cells(frame(spark, vectors), path, ["doc", "part"], cells=16)
    plan = vector_cells._Plan(read_cells(spark, path))
    queries = np.concatenate([centres, np.random.default_rng(1).normal(size=(50, 12))])
    bounds = dict(zip(plan.cell.tolist(), plan.bounds(queries).T))
    for r in spark.read.parquet(f"{path}/vectors").collect():
        v = np.array(r["embedding"], np.float64)
        scores = queries @ v / np.linalg.norm(v) / np.linalg.norm(queries, axis=1)
        assert (scores <= bounds[r["cell"]]).all()


def test_empty_index_and_empty_questions(spark, tmp_path):
    nothing = spark.createDataFrame([], SCHEMA)
    path = str(tmp_path / "c")
    write_cells(nothing, path, ["doc", "part"])
    questions = asked(spark, [[1.0, 0.0], None])
    assert retrieve_from_cells(spark, path, questions, 3, ["doc", "part"]).count() == 0
    write_cells(frame(spark, [[1.0, 2.0], [0.0, 0.0]]), path, ["doc", "part"])
    assert retrieve_from_cells(spark, path, questions.limit(0), 3, ["doc", "part"]).count() == 0
    assert [r[2:] for r in rows(retrieve_from_cells(spark, path, questions, 3, ["doc", "part"]))] == [(0, 0, 0.447213595), (0, 1, 0.0)]
