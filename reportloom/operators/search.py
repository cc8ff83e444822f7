"""Text search, snippets, highlighting, sections and grouped hits. All of it stays inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.links import base_url, is_document_url
from ..functions.parsing import column, let
from .ranking import top_k

# Field weights, smallest query, hits returned, and the marks around a hit.
WEIGHTS = {"title": 20, "section": 20, "text": 10}
MIN_QUERY = 2
LIMIT = 50
MARK_OPEN = "<mark class='search-match'>"
MARK_CLOSE = "</mark>"
BEFORE, AFTER = 50, 200
SEPARATORS = (" ", ",", ":")


def near(c: Column, query: str, fuzz: float) -> Column:
    """Some run of as many words as the query is within `fuzz` edits per query letter.

    Cut into one piece more than the edits allowed, at least one piece of the query must occur
    unchanged, so texts that hold none of them are ruled out before any run is compared.
    """
    query, allowed = query.lower(), int(fuzz * len(query))
    width, text = len(query.split()), F.lower(c)
    cuts = [len(query) * i // (allowed + 1) for i in range(allowed + 2)]
    pieces = [max(query[lo:hi].split(), key=len, default="") for lo, hi in zip(cuts, cuts[1:])]
    possible = reduce(or_, [text.contains(piece) for piece in pieces])

    def any_close(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1)))
        run = lambda i: F.array_join(F.slice(words, i, width), " ")
        return F.exists(starts, lambda i: F.levenshtein(run(i), F.lit(query), allowed) >= 0)

    return possible & let(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), any_close)


def search(
    df: DataFrame, query: str, key: str, weights: Mapping[str, int] = WEIGHTS, limit: int = LIMIT, fuzz: float = 0.0
) -> DataFrame:
    """Rows in which a field contains the query, best weighted sum first, at most `limit`.

    With `fuzz` a field also counts when a run of its words is nearly the query.
    """
    if len(query) < MIN_QUERY:
        return df.withColumn("score", F.lit(0)).limit(0)
    fields = {name: weight for name, weight in weights.items() if name in df.columns}
    parts = []
    for name, weight in fields.items():
        hit = F.lower(name).contains(query.lower())
        if int(fuzz * len(query)) > 0:
            hit = hit | near(F.col(name), query, fuzz)
        parts.append(F.when(hit, weight).otherwise(0))
    return df.withColumn("score", reduce(add, parts)).filter("score > 0").transform(top_k, "score", limit, key)


def _run_length(text: Column, from_end: bool) -> Column:
    """Length of the piece of `text` without a separator, at its start or at its end."""
    for separator in SEPARATORS:
        text = F.substring_index(text, separator, -1 if from_end else 1)
    return F.length(text)


def snippet(df: DataFrame, text: str, query: str, name: str = "snippet") -> DataFrame:
    """Add a column in which the first hit is marked and the text around it clipped.

    A hit at least 50 letters in starts the snippet right behind the separator before the hit.
    The end is looked for 200 letters on, counted in the text that already holds the marks, up to
    the next separator; `…` shows that something follows. Without a separator the last letter is
    lost, as in the behaviour this follows. Text without a hit is returned whole.

    The steps are separate columns so that each is computed once.
    """
    found, marked, start, rest, run = (F.col(f"_{part}") for part in ("found", "marked", "start", "rest", "run"))
    head = F.left(text, found - 1)
    size, reach = F.length(marked), start + len(MARK_OPEN) + len(MARK_CLOSE) + AFTER
    clipped = (reach <= size) & (run < F.length(rest))
    end = F.when(reach > size, size).when(clipped, reach + run).otherwise(size - 1)
    tail = F.substring(text, found + len(query), F.length(text))
    hit = F.substring(text, found, F.lit(len(query)))
    staged = (
        df.withColumn("_found", F.instr(F.lower(text), F.lit(query.lower())))
        .withColumn("_marked", F.when(found > 0, F.concat(head, F.lit(MARK_OPEN), hit, F.lit(MARK_CLOSE), tail)))
        .withColumn("_start", F.when(found <= BEFORE, 0).otherwise(found - 1 - _run_length(head, True)))
        .withColumn("_rest", F.substring(marked, reach + 1, size))
        .withColumn("_run", _run_length(rest, False))
    )
    short = F.concat(F.substring(marked, start + 1, end - start), F.when(clipped, "…").otherwise(""))
    return staged.withColumn(name, F.when(found > 0, short).otherwise(F.col(text))).drop(
        "_found", "_marked", "_start", "_rest", "_run"
    )


def highlight(c: Column | str, query: str, phrase: bool = False) -> Column:
    """Mark every hit of every whitespace-separated word of the query, longest first, or of the query as a whole."""
    words = [query] if phrase and query else sorted(set(query.split()), key=lambda w: (-len(w), w))
    if not words:
        return column(c)
    pattern = "(?iu)(" + "|".join(re.escape(w) for w in words) + ")"
    return F.regexp_replace(column(c), pattern, "<mark>$1</mark>")


def sections(df: DataFrame, key: str, text: str, heading: str | None = None) -> DataFrame:
    """Numbered sections for citation: the lines of the text or, with a pattern, its headings."""
    found = F.split(text, "\n") if heading is None else F.regexp_extract_all(text, F.lit(heading), F.lit(0))
    return df.select(key, F.posexplode(found).alias("section_no", "section"))


def group_hits(hits: DataFrame, href: str, order: str, collapse_after: int = 3, salts: int = 32) -> DataFrame:
    """Hits per document: the document row first, `collapse_after` rows shown, the rest counted.

    A hit without a fragment stands for the document and comes first (of several the last one). Hits
    are ranked and counted in salted pieces of a document, then the few rows each piece keeps are ranked again, so the
    hits are computed once and a document with very many hits is spread over many tasks.
    """
    keyed = hits.withColumns(
        {
            "document": base_url(href),
            "is_document": is_document_url(href),
            "_salt": F.pmod(F.xxhash64(href, order), F.lit(salts)),
        }
    )
    own = F.when(F.col("is_document"), F.col(order))
    first = [F.col("is_document").desc(), own.desc_nulls_last(), F.col(order)]
    piece = Window.partitionBy("document", "_salt")
    whole = Window.partitionBy("document")
    kept = (
        keyed.withColumns({"_place": F.row_number().over(piece.orderBy(*first)), "_size": F.count("*").over(piece)})
        .filter(F.col("_place") <= collapse_after)
        .withColumns(
            {
                "position": F.row_number().over(whole.orderBy(*first)),
                "hits": F.sum(F.when(F.col("_place") == 1, F.col("_size"))).over(whole),
            }
        )
        .filter(F.col("position") <= collapse_after)
    )
    return kept.drop("_salt", "_place", "_size").withColumns(
        {
            "row_type": F.when(F.col("position") == 1, "document").otherwise("item"),
            "remaining": F.greatest(F.col("hits") - collapse_after, F.lit(0)),
        }
    )
