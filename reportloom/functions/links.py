"""URLs, anchors and path labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .parsing import column


def suffix(c: Column | str, length: int = 7) -> Column:
    return F.right(column(c), F.lit(length))


def escape_html(c: Column | str) -> Column:
    text = F.replace(column(c), F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    return F.replace(text, F.lit("'"), F.lit("&#39;"))


def link_html(title: Column | str, url: Column | str) -> Column:
    """Anchor cell opening in a new tab, in a fixed format; title and address are escaped."""
    title, url = escape_html(title), escape_html(url)
    return F.concat(
        F.lit("<a target='_blank' title='"), title, F.lit("' href='"), url, F.lit("' rel='noopener'>"), title, F.lit("</a>")
    )


def base_url(url: Column | str) -> Column:
    return F.substring_index(column(url), "#", 1)


def is_document_url(url: Column | str) -> Column:
    return F.instr(column(url), "#") == 0


def add_param(url: Column | str, key: str, value: Column | str) -> Column:
    """Add `key=value` in front of any fragment.

    A `?` in first position does not count as an existing query string.
    """
    url = column(url)
    base = base_url(url)
    joiner = F.when(F.instr(base, "?") > 1, "&").otherwise("?")
    value = F.lit(value) if isinstance(value, str) else value
    return F.concat(base, joiner, F.lit(f"{key}="), value, F.substring(url, F.length(base) + 1, F.length(url)))
