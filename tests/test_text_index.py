"""The text index against searching all texts."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from reportloom.operators import text_index
from reportloom.operators.search import near, search
from reportloom.operators.text_index import BEGIN, END, TextIndex, _grams, _postings, search_index, write_index

WORDS = "harbour harbor harbours labour arbour a b ab the thee Bay BAY bay-side über été x1 international internationally".split()
GAPS = [" ", " ", " ", " ", "  ", "\n", "\t", " \n"]


def documents(spark, n=300, seed=2):
    rng = random.Random(seed)

    def text(size):
        if rng.random() < 0.05:
            return None
        found = "".join(rng.choice(WORDS) + rng.choice(GAPS) for _ in range(rng.randint(0, size)))
        if rng.random() < 0.3 and found:  # a slip
            at = rng.randrange(len(found))
            found = found[:at] + rng.choice("abx ") + found[at + rng.randint(0, 1) :]
        return found

    rows = [(i, text(3), text(2), text(40)) for i in range(n)] + [(n, None, None, None), (n + 1, "", " ", "\n")]
    return spark.createDataFrame(rows, "id long, title string, section string, text string").repartition(4)


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    docs = documents(spark)
    write_index(docs, path, "id", folders=16)
    return docs, path


QUERIES = [
    ("harbour", 0.0), ("arb", 0.0), ("ab", 0.0), ("HARBOUR", 0.1), ("internationol", 0.1), ("internationally", 0.2), ("the bay", 0.0),
    ("a b", 0.0), ("our the", 0.0), ("b a the", 0.0), ("bay harbour", 0.1), ("bay harbuor", 0.1), ("the internationl bay", 0.1),
    ("a harbour", 0.2), ("international arbour labour", 0.1), (" the", 0.0), ("the  bay", 0.0), ("thee ", 0.0), ("ab x1", 0.4),
    ("no such words", 0.1), ("über", 0.0), ("été bay", 0.0), ("x", 0.0), ("bay\nthe", 0.0), ("nothing", 0.5), ("-", 0.0), ("y-s", 0.0),
]


@pytest.mark.parametrize("query, fuzz", QUERIES)
def test_same_hits_as_a_scan(spark, indexed, query, fuzz):
    docs, path = indexed
    weights = {"title": 20, "section": 20, "text": 10}
    want = search(docs, query, "id", weights, 400, fuzz)
    got = search_index(docs, path, query, "id", weights, 400, fuzz)
    assert got.columns == want.columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_limit_weights_and_missing_fields(spark, indexed):
    docs, path = indexed
    for weights in ({"text": 3}, {"title": 1, "absent": 5}, {"section": 2, "title": 0}):
        got = search_index(docs, path, "harbour", "id", weights, 7)
        assert [(r["id"], r["score"]) for r in got.collect()] == [(r["id"], r["score"]) for r in search(docs, "harbour", "id", weights, 7).collect()]


def folders_read(plan: str, table: str) -> set[str]:
    """Partition filters of the scans of a table."""
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and f"/{table}]" in line]
    return {line.split("PartitionFilters: [")[1].split("], ")[0] for line in scans}


def test_only_the_folders_of_the_query_are_read(spark, indexed):
    docs, path = indexed
    index = TextIndex(spark, path)
    found = index.terms("harbour", begins=False, ends=False)
    terms = {r["term"] for r in found.collect()}
    assert {"harbour", "harbours"} <= terms and all("harbour" in t for t in terms)
    (grams,) = folders_read(plan_of(found), "grams")
    assert "folder" in grams and "," not in grams.replace("isnotnull(folder#", "").split("folder#")[-1]  # one gram, one folder
    (postings,) = folders_read(plan_of(index.postings(found)), "postings")
    assert "folder" in postings and postings.split("folder#")[-1].count(",") < len(terms)
    plan = plan_of(search_index(docs, path, "harbour", "id"))
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram" in plan or "In(gram" in plan
    near = plan_of(search_index(docs, path, "internationol", "id", fuzz=0.1))
    assert "levenshtein(term" in near and "levenshtein(text" not in near


def test_pieces_of_words(spark):
    words = ["a", "ab", "über", "aaaa", "x" * 300_000 + "yz", "e\u0301\U0001f600"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", _grams(F.col("w")).alias("g")).collect()
    for r in got:
        marked = BEGIN + r["w"] + END
        assert sorted(r["g"]) == sorted({marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)})


def test_index_of_an_empty_table(spark, tmp_path):
    docs = documents(spark).limit(0)
    write_index(docs, str(tmp_path / "i"), "id")
    assert search_index(docs, str(tmp_path / "i"), "harbour", "id").count() == 0
    assert search_index(docs, str(tmp_path / "i"), "harbour bay", "id", fuzz=0.1).count() == 0


def test_postings_need_no_shuffle_unless_keys_repeat(spark, tmp_path):
    rows = [(1, "b a  b", "a"), (2, None, "c a"), (2, "a", "a"), (None, "d", ""), (None, "d", None)]
    docs = spark.createDataFrame(rows, "id int, title string, text string")
    assert "Exchange" not in plan_of(_postings(docs, "id", ["title", "text"]))
    write_index(docs, str(tmp_path / "i"), "id", folders=4)
    stored = spark.read.parquet(str(tmp_path / "i" / "postings")).collect()
    got = {(r.term, r.field, r.key): r.places for r in stored}
    assert len(stored) == len(got)
    assert got == {
        ("a", "title", 1): [3], ("b", "title", 1): [0, 4], ("a", "text", 1): [0], ("c", "text", 2): [0], ("a", "text", 2): [0, 3],
        ("a", "title", 2): [0], ("d", "title", None): [0, 0],
    }
    counts = {(r.term, r.documents) for r in spark.read.parquet(str(tmp_path / "i" / "grams")).select("term", "documents").collect()}
    assert counts == {("a", 4), ("b", 1), ("c", 1), ("d", 1)}


def test_places_of_common_words_are_read_in_few_documents(spark, indexed, monkeypatch):
    """Only the documents of a word with an even share of the grams are looked at for the rest of a run."""
    docs, path = indexed
    asked, index = [], TextIndex(spark, path)
    look = TextIndex.postings
    monkeypatch.setattr(TextIndex, "postings", lambda self, terms, within=None: asked.append((terms, within)) or look(self, terms, within))
    runs = index.near_runs(["the", "internationl", "bay"], 1)
    (strong, everywhere), (every, documents_of) = asked
    assert everywhere is None and documents_of is not None and runs.count() > 0
    assert {"the", "bay"}.isdisjoint(r.term for r in strong.collect()) and {"the", "bay"} <= {r.term for r in every.collect()}


def test_lists_are_shuffled_and_rows_are_filed_in_order(spark, tmp_path, monkeypatch):
    """A word's postings travel as one list for many documents; the stored rows are single, sorted ones."""
    texts = ["b a\tb  Ünï a", None, "", " ", "a", "b a b\U0001f600 c\u00a0d"]
    rows = [((i, str(i)), texts[i % 6] if i % 7 else None, texts[i % 5]) for i in range(400)]
    docs = spark.createDataFrame(rows, "id struct<a: int, b: string>, title string, text string").coalesce(1)
    for most in (text_index.TEXT_BYTES, 40):
        monkeypatch.setattr(text_index, "TEXT_BYTES", most)
        lists = text_index._gathered(docs, "id", ["title", "text"])
        assert lists.count() == lists.select("term", "field").distinct().count() or most == 40
        want = {}
        for key, *fields in rows:
            for field, text in zip(("title", "text"), fields):
                pieces, n = (text or "").lower().replace("\t", "  ").split(" "), 0
                for i, word in enumerate(pieces):
                    if word:
                        want.setdefault((word, field, key), []).append(2 * n + (n > 0 and pieces[i - 1] != ""))
                        n += 1
        assert {(r.term, r.field, tuple(r.key)): r.places for r in _postings(docs, "id", ["title", "text"]).collect()} == want
        path = tmp_path / str(most)
        write_index(docs, str(path), "id", folders=4)
        stored = [(r.term, r.field, tuple(r.key), r.places) for r in spark.read.parquet(str(path / "postings")).collect()]
        assert len(stored) == len(want) and {x[:3]: x[3] for x in stored} == want
        documents_of = Counter(term for term, *_ in want)
        grams = spark.read.parquet(str(path / "grams")).collect()
        assert len(grams) == len({(r.gram, r.term) for r in grams}) and {r.term: r.documents for r in grams} == documents_of
        for table, column in (("postings", "term"), ("grams", "gram")):
            for file in (path / table).rglob("*.parquet"):
                values = [v.encode() for v in pq.ParquetFile(file).read()[column].to_pylist()]
                assert values == sorted(values)


def test_one_edit_is_looked_for_in_near_words_only(spark, tmp_path, monkeypatch):
    """With one edit words other than those within it take no part, and a phrase looks for its common words where its rare one is."""
    texts = ["the harbour bay", "harbourthe", "the harbur", "harbour the", "theharbour", "then harbour", "thes harbours"] + ["the bay harbouring others"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    path = str(tmp_path / "i")
    write_index(docs, path, "id", folders=4)
    asked, look = [], TextIndex.postings
    monkeypatch.setattr(TextIndex, "postings", lambda self, terms, within=None: asked.append((terms, within)) or look(self, terms, within))
    index = TextIndex(spark, path)
    for query in ("the harbour", "harbour bay"):
        want = [tuple(r) for r in search(docs, query, "id", limit=100, fuzz=0.1).collect()]
        assert [tuple(r) for r in search_index(docs, path, query, "id", limit=100, fuzz=0.1).collect()] == want
    asked.clear()
    assert {r["key"] for r in index.near_runs(["the", "harbour"], 1).collect()} >= {0, 2, 4, 5}
    assert {r["term"] for r in asked[-1][0].collect()} == {"the", "then", "thes", "harbour", "harbur", "harbours", "theharbour"}
    asked.clear()
    assert [r["key"] for r in index.phrase(["harbour", "bay"]).collect()] == [0]
    (rare, anywhere), (_, within) = asked
    assert {r["term"] for r in rare.collect()} == {"harbour", "theharbour"} and anywhere is None and within.count() == 4


def test_texts_are_compared_behind_the_join(spark):
    """Texts of documents that are no candidates are not compared with the query."""
    docs = spark.createDataFrame([(1, "the bay"), (2, "the bag"), (3, "tea bag")], "id long, text string")
    runs = spark.createDataFrame([(1, "text"), (3, "text")], "key long, field string")
    found = text_index._confirmed(docs, runs, "id", {"text": 10}, "the bay", 0.2)
    assert [r["key"] for r in found.collect()] == [1]
    compared = [line for line in plan_of(found).split("\n") if "levenshtein" in line]
    assert compared and all("Join" in line for line in compared)  # a condition of the join
    assert docs.where(near(F.col("text"), "the bay", 0.2)).count() == 2
