"""Row filters. Every one is a plain predicate, so it reaches the scan where the source allows it."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.parsing import column
from ..functions.periods import quarter_bounds

# Fixed value: how the reports spell a missing answer, in both languages.
NOT_AVAILABLE = "Not Available|non disponible"


def drop_sentinel(df: DataFrame, name: str, value) -> DataFrame:
    """`!=` under three-valued logic: null rows go as well."""
    return df.filter(F.col(name) != value)


def matches(**equal) -> Column:
    """Conjunction of equalities, for use as a slice predicate in one-pass comparisons."""
    return reduce(and_, [F.col(name) == value for name, value in equal.items()])


def slice_rows(df: DataFrame, **equal) -> DataFrame:
    return df.filter(matches(**equal))


def in_quarter(df: DataFrame, day: str, year: int, quarter: int) -> DataFrame:
    """A half-open date range, which the Parquet scan can use (`year(day) = y` cannot be pushed)."""
    start, end = quarter_bounds(year, quarter)
    return between_days(df, day, start, end)


def between_days(df: DataFrame, day: str, start: dt.date, end: dt.date) -> DataFrame:
    return df.filter((F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end)))


def keep_in(df: DataFrame, name: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(name).isin(list(values)))


def keep_not_in(df: DataFrame, name: str, values: Iterable) -> DataFrame:
    return df.filter(~F.col(name).isin(list(values)))


def not_like(df: DataFrame, name: str, pattern: str = NOT_AVAILABLE) -> DataFrame:
    return df.filter(~F.col(name).rlike(pattern))


def having(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.filter(condition)


def positive(df: DataFrame, measure: str) -> DataFrame:
    return df.filter(F.col(measure) > 0)


def until_year(df: DataFrame, day: str, year: int | None) -> DataFrame:
    """Everything up to the end of `year`, as a date range; nothing when there is no such year."""
    if year is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(day) < F.lit(dt.date(year + 1, 1, 1)))


def last_complete_year(df: DataFrame, day: str) -> int | None:
    """Latest year in which all twelve months occur; collects one number."""
    months = df.groupBy(F.year(day).alias("y"), F.month(day).alias("m")).agg(F.lit(1).alias("one"))
    full = months.filter("y is not null").groupBy("y").agg(F.count("*").alias("n")).filter("n = 12")
    return full.agg(F.max("y")).first()[0]


def dropna_keys(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names))


def parse_range(text: str) -> tuple[str | None, str | None] | None:
    """`lo ... hi` with either end open; anything else is no range."""
    ends = re.sub(r"\s", "", text).split("...")
    if len(ends) != 2:
        return None
    return ends[0] or None, ends[1] or None


def range_filter(df: DataFrame, name: str, low=None, high=None, kind: str = "double") -> DataFrame:
    """Inclusive range; a value that is not of `kind` (double, date, timestamp) is left out."""
    source = dict(df.dtypes)[name]
    value = F.col(name).try_cast(kind) if source == "string" else F.col(name)

    def bound(end) -> Column:
        return F.lit(float(end)) if kind == "double" else F.lit(end).cast(kind if source == "string" else source)

    keep = [value.isNotNull()]
    if low is not None:
        keep.append(value >= bound(low))
    if high is not None:
        keep.append(value <= bound(high))
    if source in ("double", "float") or (source == "string" and kind == "double"):
        keep.append(~F.isnan(value))
    return df.filter(reduce(and_, keep))


def choice_filter(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Multi-select; None (or `na` on a logical column) picks nulls; an empty selection keeps everything."""
    if not values:
        return df
    absent = (None, "na") if dict(df.dtypes)[name] == "boolean" else (None,)
    known = [v for v in values if v not in absent]
    wanted = []
    if known:
        wanted.append(F.col(name).isin(known))
    if len(known) < len(values):
        wanted.append(F.col(name).isNull())
    return df.filter(reduce(or_, wanted))


def search_predicate(c: Column | str, query: str, regex: bool = True, ignore_case: bool = True) -> Column:
    """Regex match, or (plain) every whitespace-separated word contained somewhere."""
    value = column(c)
    if regex:
        return value.rlike(("(?iu)" if ignore_case else "") + query)
    if ignore_case:
        value, query = F.lower(value), query.lower()
    return reduce(and_, [value.contains(word) for word in query.split()], F.lit(True))


def column_search(df: DataFrame, name: str, query: str, regex: bool = True, ignore_case: bool = True) -> DataFrame:
    """Rows whose column matches; an empty query (as plain text, blanks too) keeps everything, nulls included."""
    if not (query if regex else query.strip()):
        return df
    return df.filter(search_predicate(name, query, regex, ignore_case))


def table_search(df: DataFrame, query: str, regex: bool = True, ignore_case: bool = True) -> DataFrame:
    """Rows in which any column, read as text, matches; an empty query (as plain text, blanks too) keeps everything."""
    if not (query if regex else query.strip()):
        return df
    hits = [F.coalesce(search_predicate(F.col(n).cast("string"), query, regex, ignore_case), F.lit(False)) for n in df.columns]
    return df.filter(reduce(or_, hits))


def tag_filter(df: DataFrame, name: str, tag: str, separator: str = ",") -> DataFrame:
    """Rows whose tag list holds `tag`; an empty tag keeps everything, a null list never matches."""
    if tag == "":
        return df
    tags = F.col(name) if dict(df.dtypes)[name].startswith("array") else F.split(name, re.escape(separator))
    return df.filter(F.array_contains(tags, tag))


def facet_filter(
    df: DataFrame,
    key: str,
    choices: Mapping[str, Sequence] | None = None,
    ranges: Mapping[str, tuple] | None = None,
    linked: Sequence[tuple[DataFrame, str, Sequence]] = (),
) -> DataFrame:
    """OR inside a facet, AND across facets.

    `choices` and `ranges` are facets held in columns of `df` and become scan predicates. `linked`
    are facets of other tables, given as (table, group column, chosen groups); each table carries
    `key` and narrows `df` with a semi join, after its keys were made distinct, so that a key with
    very many rows is folded before the shuffle. A facet without a choice does not filter.
    """
    for name, values in (choices or {}).items():
        if values:
            df = keep_in(df, name, values)
    for name, (low, high) in (ranges or {}).items():
        df = facet_range(df, name, low, high)
    for table, group, values in linked:
        if values:
            df = df.join(keep_in(table, group, values).select(key).distinct(), key, "left_semi")
    return df


def facet_range(df: DataFrame, name: str, low, high) -> DataFrame:
    return df.filter(F.col(name).between(low, high))
