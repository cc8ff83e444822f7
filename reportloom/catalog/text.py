"""Text search, documents and vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ..operators.retrieval import index_documents, retrieve
from ..operators.search import highlight, search, sections, snippet
from ..operators.text_index import search_index, write_index
from ..operators.vector_cells import retrieve_from_cells, write_cells
from ..plans.feed_digest import feed_items
from ..plans.site_search import search_site
from ..sources.tables import table
from ..workspace import fresh_dir
from .registry import ORACLE, query
from .sources import CHUNKS_SQL, ITEMS_SQL

PAGES_SQL = (
    ITEMS_SQL
    + """,
search_v AS (SELECT page_id, lower(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title,
  lower(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)) AS section, lower(item_description) AS body
  FROM pages JOIN items_v USING (page_id))"""
)


def near_sql(field: str, wanted: str) -> str:
    """One word of the field within one edit of the word."""
    words = f"string_split(trim(regexp_replace({field}, '\\s+', ' ', 'g')), ' ')"
    return f"(contains({field}, '{wanted}') OR len(list_filter({words}, lambda x: levenshtein(x, '{wanted}') <= 1)) > 0)"


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def search_docs(spark, sf_dir):
    """Pages as search documents: title, first heading, body text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    heading = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return feed_items(pages.withColumn("section", heading), "section").withColumnRenamed("description", "text")


@query(
    "t01_search",
    f"""WITH {PAGES_SQL}
        SELECT * FROM (SELECT page_id, CAST(CASE WHEN contains(title, 'heon') THEN 20 ELSE 0 END
          + CASE WHEN contains(section, 'heon') THEN 20 ELSE 0 END
          + CASE WHEN contains(body, 'heon') THEN 10 ELSE 0 END AS INTEGER) AS score FROM search_v)
        WHERE score > 0 ORDER BY score DESC, page_id LIMIT 50""",
)
def t01(spark, sf_dir):
    return search(search_docs(spark, sf_dir), "Heon", "page_id").select("page_id", "score")


SITE_SQL = (
    PAGES_SQL
    + """,
hits_v AS (SELECT page_id, CAST(row_number() OVER (ORDER BY score DESC, page_id) AS INTEGER) AS place, score, url, item_description AS text
  FROM (SELECT page_id, CAST(CASE WHEN contains(title, 'heon') THEN 20 ELSE 0 END + CASE WHEN contains(section, 'heon') THEN 20 ELSE 0 END
          + CASE WHEN contains(body, 'heon') THEN 10 ELSE 0 END AS INTEGER) AS score FROM search_v)
       JOIN pages USING (page_id) JOIN items_v USING (page_id)
  WHERE score > 0 ORDER BY score DESC, page_id LIMIT 50),
found_v AS (SELECT *, split_part(url, '#', 1) AS base, instr(lower(text), 'heon') AS found FROM hits_v),
marked_v AS (SELECT *, base || CASE WHEN instr(base, '?') > 1 THEN '&' ELSE '?' END || 'q=heon' AS document, substr(url, length(base) + 1) AS anchor,
  substr(text, 1, found - 1) AS head, substr(text, 1, found - 1) || '<mark class=''search-match''>' || substr(text, found, 4)
  || '</mark>' || substr(text, found + 4) AS marked FROM found_v),
start_v AS (SELECT *, CASE WHEN found - 1 < 50 THEN 0
  ELSE found - 1 - length(split_part(split_part(split_part(head, ' ', -1), ',', -1), ':', -1)) END AS start FROM marked_v),
rest_v AS (SELECT *, length(marked) AS size, start + 234 AS reach, substr(marked, start + 235) AS rest FROM start_v),
run_v AS (SELECT *, length(split_part(split_part(split_part(rest, ' ', 1), ',', 1), ':', 1)) AS run FROM rest_v)"""
)


@query(
    "t01_site_search",
    f"""WITH {SITE_SQL}
        SELECT page_id, place, score, document || anchor AS link, document, count(*) OVER (PARTITION BY document) AS hits,
               CASE WHEN found = 0 THEN text ELSE substr(marked, start + 1, CASE WHEN reach > size THEN size
                 WHEN run < length(rest) THEN reach + run ELSE size - 1 END - start)
                 || CASE WHEN reach <= size AND run < length(rest) THEN '…' ELSE '' END END AS snippet FROM run_v""",
)
def t01_site(spark, sf_dir):
    docs = search_docs(spark, sf_dir).withColumnRenamed("link", "href")
    found = search_site(docs, "heon", "page_id")
    return found.select("page_id", "place", "score", "link", "document", "hits", "snippet")


@query(
    "t01_site_search_misspelt",
    f"""WITH {PAGES_SQL}
        SELECT page_id, CAST(row_number() OVER (ORDER BY score DESC, page_id) AS INTEGER) AS place, score FROM (
          SELECT page_id, CAST(CASE WHEN {near_sql("title", "byanthblaly")} THEN 20 ELSE 0 END
            + CASE WHEN {near_sql("section", "byanthblaly")} THEN 20 ELSE 0 END
            + CASE WHEN {near_sql("body", "byanthblaly")} THEN 10 ELSE 0 END AS INTEGER) AS score FROM search_v)
        WHERE score > 0 ORDER BY score DESC, page_id LIMIT 50""",
)
def t01_misspelt(spark, sf_dir):
    """Site search forgives one wrong letter in ten."""
    docs = search_docs(spark, sf_dir).withColumnRenamed("link", "href")
    return search_site(docs, "byanthblaly", "page_id", collapse_after=50).select("page_id", "place", "score")


@query(
    "t02_search_fuzzy",
    """WITH d AS (SELECT doc_id, lower(text) AS t, string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ') AS w FROM documents),
            g AS (SELECT doc_id, t, list_transform(range(1, greatest(len(w) - 1, 1) + 1),
                                                   lambda i: array_to_string(w[i : i + 1], ' ')) AS grams FROM d)
       SELECT doc_id, 10 AS score FROM g
       WHERE contains(t, 'thetion and') OR len(list_filter(grams, lambda x: levenshtein(x, 'thetion and') <= 1)) > 0
       ORDER BY doc_id LIMIT 50""",
)
def t02(spark, sf_dir):
    return search(documents(spark, sf_dir), "thetion and", "doc_id", fuzz=0.1).select("doc_id", "score")


@query(
    "t02_near_match",
    """WITH d AS (SELECT doc_id, lower(text) AS t, string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ') AS w FROM documents),
            g AS (SELECT doc_id, t, list_transform(range(1, greatest(len(w) - 1, 1) + 1),
                                                   lambda i: array_to_string(w[i : i + 1], ' ')) AS grams FROM d)
       SELECT doc_id, 10 AS score FROM g
       WHERE contains(t, 'to thanedbla') OR len(list_filter(grams, lambda x: levenshtein(x, 'to thanedbla') <= 1)) > 0
       ORDER BY doc_id LIMIT 50""",
)
def t02_near(spark, sf_dir):
    """A misspelt query: every hit is a near match."""
    return search(documents(spark, sf_dir), "to thanedbla", "doc_id", fuzz=0.1).select("doc_id", "score")


def indexed(spark, docs, key):
    """The folder of an index made from the search documents."""
    path = fresh_dir(spark, "text-index")
    write_index(docs, path, key)
    return path


@query("t01_search_index", ORACLE["t01_search"])
def t01_index(spark, sf_dir):
    """The same hits from stored postings."""
    docs = search_docs(spark, sf_dir)
    return search_index(docs, indexed(spark, docs, "page_id"), "Heon", "page_id").select("page_id", "score")


@query("t01_site_search_index", ORACLE["t01_site_search"])
def t01_site_index(spark, sf_dir):
    docs = search_docs(spark, sf_dir).withColumnRenamed("link", "href")
    found = search_site(docs, "heon", "page_id", index=indexed(spark, docs, "page_id"))
    return found.select("page_id", "place", "score", "link", "document", "hits", "snippet")


@query("t01_site_search_misspelt_index", ORACLE["t01_site_search_misspelt"])
def t01_misspelt_index(spark, sf_dir):
    """One wrong letter in ten: words that share enough three-letter pieces with the query."""
    docs = search_docs(spark, sf_dir).withColumnRenamed("link", "href")
    path = indexed(spark, docs, "page_id")
    return search_site(docs, "byanthblaly", "page_id", collapse_after=50, index=path).select("page_id", "place", "score")


@query("t02_search_fuzzy_index", ORACLE["t02_search_fuzzy"])
def t02_index(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return search_index(docs, indexed(spark, docs, "doc_id"), "thetion and", "doc_id", fuzz=0.1).select("doc_id", "score")


@query("t02_near_match_index", ORACLE["t02_near_match"])
def t02_near_index(spark, sf_dir):
    """Runs of words that share enough pieces with the query are confirmed in their documents, no others are read."""
    docs = documents(spark, sf_dir)
    return search_index(docs, indexed(spark, docs, "doc_id"), "to thanedbla", "doc_id", fuzz=0.1).select("doc_id", "score")


@query(
    "t03_snippet",
    """WITH f AS (SELECT doc_id, text, instr(lower(text), 'tionth') AS found FROM documents),
            m AS (SELECT *, substr(text, 1, found - 1) AS head, substr(text, 1, found - 1) || '<mark class=''search-match''>'
                         || substr(text, found, 6) || '</mark>' || substr(text, found + 6) AS marked FROM f WHERE found > 0),
            s AS (SELECT *, CASE WHEN found - 1 < 50 THEN 0
                         ELSE found - 1 - length(split_part(split_part(split_part(head, ' ', -1), ',', -1), ':', -1)) END AS start FROM m),
            r AS (SELECT *, length(marked) AS size, start + 234 AS reach, substr(marked, start + 235) AS rest FROM s),
            e AS (SELECT *, length(split_part(split_part(split_part(rest, ' ', 1), ',', 1), ':', 1)) AS run FROM r)
       SELECT doc_id, substr(marked, start + 1, CASE WHEN reach > size THEN size WHEN run < length(rest) THEN reach + run
                      ELSE size - 1 END - start) || CASE WHEN reach <= size AND run < length(rest) THEN '…' ELSE '' END AS snippet FROM e
       UNION ALL SELECT doc_id, text FROM f WHERE found = 0""",
)
def t03(spark, sf_dir):
    return snippet(documents(spark, sf_dir), "text", "tionTH").drop("text")


@query(
    "t04_highlight",
    "SELECT doc_id, regexp_replace(text, '(tion|the)', '<mark>\\1</mark>', 'gi') AS marked FROM documents",
)
def t04(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", highlight("text", "the tion").alias("marked"))


@query(
    "t04_highlight_phrase",
    "SELECT doc_id, regexp_replace(text, '(tion the)', '<mark>\\1</mark>', 'gi') AS marked FROM documents",
)
def t04_phrase(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", highlight("text", "tion the", phrase=True).alias("marked"))


SLOTS_SQL = "list_transform({words}, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT % 64)"
VECTOR_SQL = "list_transform(range(64), lambda d: CAST(len(list_filter(slots, lambda s: s = d)) AS DOUBLE))"


@query(
    "t05_index_documents",
    f"""WITH {CHUNKS_SQL},
             slots_v AS (SELECT doc_id, chunk_no, cw, {SLOTS_SQL.format(words="list_transform(cw, lambda y: lower(y))")} AS slots FROM chunks_v)
        SELECT doc_id, chunk_no, array_to_string(cw, ' ') AS chunk,
               array_to_string(list_transform({VECTOR_SQL}, lambda v: CAST(CAST(v AS INTEGER) AS VARCHAR)), ',') AS vector FROM slots_v""",
)
def t05(spark, sf_dir):
    index = index_documents(documents(spark, sf_dir), "doc_id", "text")
    vector = F.array_join(F.col("embedding").cast("array<int>").cast("array<string>"), ",")
    return index.select("doc_id", "chunk_no", "chunk", vector.alias("vector"))


def label_centres(vectors):
    """One question vector per label: the mean of its vectors."""
    mean = Summarizer.mean(array_to_vector("embedding"))
    return vectors.groupBy(F.col("label").alias("query_id")).agg(vector_to_array(mean).alias("embedding"))


@query(
    "t06_retrieve",
    """WITH parts AS (SELECT label, unnest(range(64)) AS pos, unnest(embedding) AS x FROM embeddings),
            means AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM parts GROUP BY 1, 2),
            asked AS (SELECT label AS query_id, list(x ORDER BY pos) AS q FROM means GROUP BY 1),
            scored AS (SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) AS score
                       FROM embeddings, asked)
       SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (
              PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10""",
)
def t06(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return retrieve(vectors, label_centres(vectors), 10, ["vec_id"]).select("query_id", "vec_id", "rank")


@query("t06_retrieve_cells", ORACLE["t06_retrieve"])
def t06_cells(spark, sf_dir):
    """The same rows from a stored index of cells, of which a question opens those that can hold one of its best rows."""
    vectors, path = table(spark, sf_dir, "embeddings"), fresh_dir(spark, "cells")
    write_cells(vectors, path, ["vec_id"], cells=64)
    return retrieve_from_cells(spark, path, label_centres(vectors), 10, ["vec_id"]).select("query_id", "vec_id", "rank")


@query(
    "t07_sections",
    """SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS section_no, unnest(s) AS section
       FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)""",
)
def t07(spark, sf_dir):
    return sections(table(spark, sf_dir, "documents"), "doc_id", "text")
