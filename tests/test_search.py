from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportloom.operators import search as S


def brute_snippet(text: str, query: str) -> str:
    """The clipping rules letter by letter."""
    at = text.lower().find(query.lower())
    if at < 0:
        return text
    marked = text[:at] + S.MARK_OPEN + text[at : at + len(query)] + S.MARK_CLOSE + text[at + len(query) :]
    start = 0
    if at >= 50:
        start = at
        while start > 0 and marked[start - 1] not in " ,:":
            start -= 1
    reach = start + len(S.MARK_OPEN) + len(S.MARK_CLOSE) + 200
    if reach > len(marked):
        return marked[start:]
    end = reach
    while end < len(marked) and marked[end] not in " ,:":
        end += 1
    if end == len(marked):
        return marked[start : end - 1]
    return marked[start:end] + "…"


def snippets(spark, texts, query):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.snippet for r in S.snippet(df, "t", query).orderBy("i").collect()]


def test_snippets(spark):
    words = "word " * 60
    texts = [
        "Loss at the start " + words,
        words + "the Loss in the middle " + words,
        words + "ends with loss",
        "none here",
        "short loss text",
        "x" * 80 + "loss" + "y" * 400,
        words + "a,b:" + "z" * 70 + "loss" + "y" * 260 + " tail",
        "é" * 49 + "loss, " + words,
        "é" * 50 + "loss, " + words,
        None,
    ]
    assert snippets(spark, texts, "LOSS") == [None if t is None else brute_snippet(t, "loss") for t in texts]
    assert snippets(spark, ["cost (a+b)* here"], "(a+b)*") == ["cost <mark class='search-match'>(a+b)*</mark> here"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text("ab ,:", max_size=420), min_size=1, max_size=12))
def test_snippets_on_any_text(spark, texts):
    assert snippets(spark, texts, "ba") == [brute_snippet(t, "ba") for t in texts]


def test_highlight_can_be_undone(spark):
    text = "The cat (and THE hat) cost $5.00+"
    df = spark.createDataFrame([(text,)], "t string")
    marked = df.select(S.highlight("t", "the $5.00+ (and").alias("m")).first().m
    assert marked.count("<mark>") == 4 and re.sub("</?mark>", "", marked) == text
    assert df.select(S.highlight("t", " ").alias("m")).first().m == text
    whole = df.select(S.highlight("t", "HAT) cost $5", phrase=True).alias("m")).first().m
    assert whole == "The cat (and THE <mark>hat) cost $5</mark>.00+"


def test_search_weights_and_limit(spark):
    rows = [(1, "fraud", "x", "fraud"), (2, "x", "Fraud", "x"), (3, "x", "x", "a fraud case"), (4, "x", "x", "x")]
    df = spark.createDataFrame(rows, "id int, title string, section string, text string")
    assert [(r.id, r.score) for r in S.search(df, "fraud", "id").collect()] == [(1, 30), (2, 20), (3, 10)]
    assert S.search(df, "f", "id").count() == 0 and S.search(df, "fraud", "id", limit=2).count() == 2


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("query", ["identity theft", "protection", "bank investigators call"])
def test_fuzzy_search_against_brute_force(spark, query):
    texts = [
        "An identity thefts case", "identty theft", "idntty theft", "identity  \n theft", "my protektion plan", "protekton",
        "the bank investigatrs cal", "bank investigators", "BANK INVESTIGATORS CALL", "", "theft identity", "prot ection",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    allowed, width = int(0.1 * len(query)), len(query.split())
    want = set()
    for i, text in enumerate(texts):
        words = text.lower().split()
        runs = [" ".join(words[j : j + width]) for j in range(max(len(words) - width + 1, 1))]
        if query in text.lower() or any(edits(run, query) <= allowed for run in runs):
            want.add(i)
    assert {r.id for r in S.search(df, query, "id", fuzz=0.1).collect()} == want


def test_sections(spark):
    df = spark.createDataFrame([(1, "SEC. 1. Scope\nbody SEC. 12. Funds\nend")], "id int, t string")
    assert [r.section for r in S.sections(df, "id", "t").collect()] == ["SEC. 1. Scope", "body SEC. 12. Funds", "end"]
    heads = S.sections(df, "id", "t", r"SEC\. \d+\. \w+").collect()
    assert [(r.section_no, r.section) for r in heads] == [(0, "SEC. 1. Scope"), (1, "SEC. 12. Funds")]


@pytest.mark.parametrize("salts", [1, 4, 32])
def test_group_hits_with_a_hot_document(spark, salts):
    rows = [("/hot#%d" % i, i) for i in range(500)] + [("/hot", 900), ("/one", 3), ("/two#a", 1), ("/two#b", 0)]
    rows += [("/own", 1), ("/own#x", 0), ("/own", 2)]
    out = S.group_hits(spark.createDataFrame(rows, "href string, rank int"), "href", "rank", 3, salts)
    got = {(r.document, r.position): r for r in out.collect()}
    places = [("/hot", 3), ("/one", 1), ("/own", 3), ("/two", 2)]
    assert sorted(got) == [(document, i) for document, n in places for i in range(1, n + 1)]
    assert [got["/own", p]["rank"] for p in (1, 2, 3)] == [2, 1, 0]
    assert [got["/hot", p].href for p in (1, 2, 3)] == ["/hot", "/hot#0", "/hot#1"]
    assert (got["/hot", 1].hits, got["/hot", 1].remaining, got["/hot", 1].row_type) == (501, 498, "document")
    assert got["/two", 1].href == "/two#b" and got["/two", 2].row_type == "item" and got["/two", 2].remaining == 0
    assert out.select(F.sum("position")).first()[0] == 16
