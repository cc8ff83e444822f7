"""Search documents -> ranked, linked, clipped hits grouped by document; and the dated, tagged listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.links import add_param
from ..operators.filters import tag_filter
from ..operators.ranking import recent
from ..operators.search import LIMIT, group_hits, search, snippet
from ..operators.text_index import search_index

DOC_SCHEMA = "title string, section string, text string, href string, crumbs array<string>"


def read_search_docs(spark: SparkSession, path: str) -> DataFrame:
    """Search documents from JSON: one array per file, or one object per line (`.jsonl`)."""
    whole_files = not path.endswith(".jsonl")
    return spark.read.schema(DOC_SCHEMA).option("multiLine", whole_files).json(path)


# Fixed value: share of a query's letters by which a match may differ.
FUZZ = 0.1


def search_site(
    docs: DataFrame,
    query: str,
    key: str = "href",
    collapse_after: int = 3,
    limit: int = LIMIT,
    fuzz: float = FUZZ,
    index: str | None = None,
) -> DataFrame:
    """The best hits with their place, a link that carries the query, and the marked text around the hit.

    Near matches count as hits; the snippet marks exact ones. With `index`, the folder that `write_index` has filled from
    `docs`, the hits come from there and only their rows are taken from `docs`.

    The places are given after the limit, so their window holds at most `limit` rows.
    """
    place = F.row_number().over(Window.orderBy(F.col("score").desc(), key))
    if index is None:
        hits = search(docs, query, key, limit=limit, fuzz=fuzz)
    else:
        hits = search_index(docs, index, query, key, limit=limit, fuzz=fuzz)
    hits = hits.withColumn("place", place)
    linked = snippet(hits.withColumn("link", add_param("href", "q", query)), "text", query)
    return group_hits(linked, "link", "place", collapse_after)


def listing(items: DataFrame, tags: str, tag: str = "", day: str = "date", *tie_break: str) -> DataFrame:
    """Items of one tag (or all), newest first."""
    return recent(tag_filter(items, tags, tag), day, *tie_break)
