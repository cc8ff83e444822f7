"""Rates, brackets, rounding and number display."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .parsing import column

# Left-open, right-closed loss brackets and their labels, in order.
LOSS_EDGES = (0, 100, 500, 1000, 5000, 10000)
LOSS_LABELS = ("$1-100", "$101-500", "$501-1000", "$1001-5000", "$5001-10000", ">$10000")


def rate_per(count: Column | str, population_k: Column | str, per: int = 100000) -> Column:
    """Cases per `per` residents; the population column is in thousands."""
    return F.try_divide(column(count).cast("double"), column(population_k) * 1000) * per


def scale(c: Column | str, by: float) -> Column:
    return column(c).cast("double") / F.lit(float(by))


def share_pct(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole, null when the whole is zero."""
    return F.try_divide(column(part).cast("double"), column(whole).cast("double")) * 100


def change_pct(before: Column | str, after: Column | str) -> Column:
    before, after = column(before).cast("double"), column(after).cast("double")
    return F.try_divide(after - before, before) * 100


def bracket_no(c: Column | str, edges: Sequence[float] = LOSS_EDGES) -> Column:
    """1-based ordinal of the bracket (edge, next edge]; at or below the first edge: null."""
    value = column(c)
    above = [(i + 1, value > edge) for i, edge in enumerate(edges)]
    top_down = reversed(above)
    first_no, first_hit = next(top_down)
    return reduce(lambda chain, step: chain.when(step[1], step[0]), top_down, F.when(first_hit, first_no))


def bracket_label(c: Column | str, edges: Sequence[float] = LOSS_EDGES, labels: Sequence[str] = LOSS_LABELS) -> Column:
    number = bracket_no(c, edges)
    return F.when(number.isNotNull(), F.element_at(F.array(*map(F.lit, labels)), number))


def label_if(rules: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    """First matching rule names the row."""
    (first, name), *rest = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), rest, F.when(first, name))
    return chain.otherwise(F.lit(otherwise))


def rounded(c: Column | str, places: int) -> Column:
    """Half-up rounding, for display only; operators hand on unrounded values."""
    return F.round(column(c), places)


def fmt_count(c: Column | str) -> Column:
    return F.format_number(column(c), 0)


def fmt_money(c: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(column(c), 0))


def fmt_pct(c: Column | str, places: int = 1, signed: bool = False) -> Column:
    value = F.round(column(c).cast("double"), places)
    text = F.concat(F.format_string(f"%.{places}f", value), F.lit("%"))
    return F.when(value.isNotNull(), F.concat(F.when(value > 0, "+").otherwise(""), text) if signed else text)


def fmt_times(c: Column | str, places: int = 2) -> Column:
    value = F.round(column(c).cast("double"), places)
    return F.when(value.isNotNull(), F.concat(F.format_string(f"%.{places}f", value), F.lit("x")))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Money is summed as decimal; this is the edge where it becomes double."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("double").alias(name) if kind.startswith("decimal") else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
