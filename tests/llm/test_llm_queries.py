"""The registered queries: against their SQL where there is one, and the pipeline against plain stages."""

from __future__ import annotations

import re

import corpus_pipeline
import duckdb
import pytest
from corpus_fixtures import awkward_documents, documents, prose
from oracle import compare, connect
from test_llm_dedup import plain_jaccard, plain_line_dedup
from test_llm_text import plain_leaks
from test_llm_tokens import check_packing

from reportloom.llm.queries import ORACLE, QUERIES


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert [s[0] for s in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing",
    ]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01" if name in ("op1_embedding_near_dedup", "op5_chat_windows") else "/root/testdata/sf0.001"
    assert compare(connect(sf_dir), ORACLE[name], QUERIES[name](spark, sf_dir)) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    if name == "op6_benchmark_decontamination":
        docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
        items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
        fold = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
        verbatim = {(i, k) for i, t in docs for k, item in items if t and fold(item) in fold(t)}
        assert verbatim <= {(r.doc_id, r.item_id) for r in rows.collect()}
    else:
        table, key = ("pages", "page_id") if name.startswith("op3_") else ("documents", "doc_id")
        ids = duckdb.sql(f"SELECT {key} FROM '{sf_dir}/{table}.parquet'").fetchall()
        assert {r[key] for r in rows.select(key).collect()} == {i for (i,) in ids}


def test_pipeline_stages_against_plain_versions(spark, tmp_path):
    rows = [(i, t) for i, t in awkward_documents() if t is None or len(t) < 3000]
    item = "a benchmark passage of a dozen words that nobody should ever have copied"
    rows += [(900, "Intro words here. " + item + " and more"), (901, "a clean one")]
    toxic = [(1000 + i, f"{prose(7000 + i, 12)} vilething {prose(8000 + i, 9)}") for i in range(40)]
    base = str(tmp_path)
    documents(spark, rows + toxic).write.parquet(f"{base}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in rows] + [(i, 1, 1) for i, _ in toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")

    docs, seen = spark.read.parquet(f"{base}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, base).write.parquet(f"{base}/stage{k}")
        docs = spark.read.parquet(f"{base}/stage{k}")
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
            seen[name] = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(i for i, _ in seen["toxicity"]) == sorted(i for i, _ in rows)
    lines = {int(i): t for i, t, _, _ in plain_line_dedup(seen["toxicity"], 10)}
    assert dict(seen["line dedup"]) == lines
    kept = {i for i, _, least in plain_jaccard(list(lines.items()), 5, 80) if i == least}
    assert {i for i, _ in seen["n-gram Jaccard join"]} == kept
    leaks = {i for i, _ in plain_leaks([(i, lines[i]) for i in kept], [(1, item)])}
    assert leaks == {900} and {i for i, _ in seen["benchmark decontamination"]} == kept - leaks
    used, bound = check_packing(seen["benchmark decontamination"], docs.collect(), 2048)
    assert used <= bound + 1
    assert sorted(map(str, corpus_pipeline.run(spark, base).select("doc_id", "piece", "length").collect())) == sorted(
        map(str, docs.select("doc_id", "piece", "length").collect())
    )
