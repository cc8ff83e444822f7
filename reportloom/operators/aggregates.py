"""Grouped reports.

All groupings use partial aggregation, so a key that holds a large part of the rows is reduced
before the shuffle. Means are an exact decimal sum divided once. Medians are exact and never
gather a group's values in one place (see `median_profile`).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import LOSS_EDGES, LOSS_LABELS, bracket_no, change_pct, rate_per, share_pct
from ..functions.periods import month_start
from ..workspace import written
from .filters import keep_in, positive
from .joins import left_dim, literal_dim


def exact_mean(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


# ---------------------------------------------------------------- periods


def date_bounds(df: DataFrame, day: str = "date") -> DataFrame:
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def monthly_summary(df: DataFrame, day: str = "date", *by: str) -> DataFrame:
    return df.groupBy(*by, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.sum("dollar_loss").alias("total_loss"), F.sum("num_victims").alias("total_victims")
    )


def yearly_from_monthly(monthly: DataFrame) -> DataFrame:
    """Second level of the roll-up; reads the monthly rows, not the base table."""
    return monthly.groupBy("year").agg(
        F.sum("total_loss").alias("total_loss"), F.sum("total_victims").alias("total_victims")
    )


def yearly_summary(df: DataFrame, day: str = "date") -> DataFrame:
    return yearly_from_monthly(monthly_summary(df, day))


def monthly_by_cat(df: DataFrame, key: str = "fraud_cat", measure: str = "dollar_loss", day: str = "date") -> DataFrame:
    return df.groupBy(F.year(day).alias("year"), F.month(day).alias("month"), key).agg(
        F.sum(measure).alias("total_loss")
    )


def monthly_counts(df: DataFrame, day: str = "date") -> DataFrame:
    return df.filter(F.col(day).isNotNull()).groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.count("*").alias("n")
    )


def seasonality(df: DataFrame, day: str = "date") -> DataFrame:
    """Per calendar month: mean and total of the counts of the months that are present."""
    return (
        monthly_counts(df, day)
        .groupBy("month")
        .agg(exact_mean(F.sum("n"), F.count("*")).alias("avg_monthly"), F.sum("n").alias("total_monthly"))
    )


# ---------------------------------------------------------------- counts and sums


def sum_by(df: DataFrame, key: str, measure: str, name: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(measure).alias(name))


def freq(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))


def cross_freq(df: DataFrame, a: str, b: str, name: str = "n") -> DataFrame:
    """Sparse two-way counts; `complete` adds the zeros."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias(name))


def mean_count(df: DataFrame, key: str, measure: str) -> DataFrame:
    return (
        df.filter(F.col(key).isNotNull() & F.col(measure).isNotNull())
        .groupBy(key)
        .agg(exact_mean(F.sum(measure), F.count("*")).alias("avg_loss"), F.count("*").alias("n"))
    )


def margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Row and column totals of a two-way table, from one pass over its cells."""
    cells = cross_freq(df, a, b)
    totals = cells.cube(a, b).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    return totals.filter("level in (1, 2)").select(
        F.when(F.col("level") == 1, a).otherwise(b).alias("axis"), F.coalesce(a, b).alias("key"), "n"
    )


# ---------------------------------------------------------------- medians


ACCURACY = 10000  # of the quantile sketch; about 6 values in 10,000 of a group lie in the bracket
MARGIN = 3 / ACCURACY
RANKED = 4096  # distinct values of a group that one task may rank
CUTS = 512  # values by which a bracket that holds more is cut
FEW_GROUPS = 50_000  # groups whose brackets every task may hold
SALTS = 64  # parts of a group that meet its bracket in different tasks, where there are more groups


def middle_bracket(value: Column) -> Column:
    """Aggregate: two values with the middle of a group between them, or so a sketch says; counts check it."""
    return F.percentile_approx(value, [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY)


def median_profile(df: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Mean, exact median, total and count per group.

    A first pass sums and counts, and a quantile sketch gives two values of each group with the middle between
    them: MARGIN on either side, three times the sketch's error. A second pass counts what lies below, drops
    what lies above and folds the equal values between. The counts then show whether the middle ranks lie in the bracket.
    Where they do not, all values of the group are folded; where a group has more than RANKED values left, its bracket
    is narrowed by counts between sampled values until it has not. So one task ranks RANKED values of a group at most, and
    the result does not rest on the sketch. Sketch, counts and folds are partial aggregations, so no task gathers a group.
    Nor does the join with the brackets: a row per group is sent to all tasks, or with very many groups the distinct
    values of a group meet its bracket in SALTS parts.

    Runs when called (the folded values are written once). NaN counts as the greatest value, as in Spark's own median.
    Without keys there is always one row, with n = 0 for empty input. Null keys and null measures are left out.
    """
    present = F.col(measure).isNotNull()
    for key in by:
        present = present & F.col(key).isNotNull()
    groups = list(by) or ["_all"]
    rows = df.filter(present).select(*(by or [F.lit(0).alias("_all")]), F.col(measure).alias("_value"))
    infinite = F.lit(float("inf"))
    floating = dict(df.dtypes)[measure] in ("double", "float")
    known = F.when(F.isnan("_value"), infinite).otherwise(F.col("_value")) if floating else F.col("_value")
    marks = rows.groupBy(*groups).agg(
        middle_bracket(known).alias("_near"), F.min(known).alias("_least"), F.count("*").alias("_total"), F.sum("_value").alias("_grand")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    # at least a group's smallest value is below or in its bracket, so that no group is lost from sight
    end = F.greatest(F.col("_near")[1], F.col("_least"))
    top = F.when(end < infinite, end).otherwise(float("nan")) if floating else end
    brackets = marks.select(*groups, F.col("_near")[0].alias("_from"), top.alias("_to"), "_total", "_grand")
    if marks.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        marked = rows.withColumn("_n", F.lit(1)).join(F.broadcast(brackets), groups)
    else:
        marked = _salted(rows.groupBy(*groups, "_value").agg(F.count("*").alias("_n")), brackets, groups)
    middle = F.when(F.col("_value") >= F.col("_from"), F.col("_value")).alias("_value")
    sums = [F.first(c).alias(c) for c in ("_total", "_grand")]
    folded = marked.filter(F.col("_value") <= F.col("_to")).groupBy(*groups, middle).agg(F.sum("_n").alias("_n"), *sums)
    folded = written(folded, "median-values")
    marks.unpersist()
    below, within = (F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0)) for c in (F.col("_value").isNull(), F.col("_value").isNotNull()))
    state = folded.groupBy(*groups).agg(below.alias("_below"), within.alias("_within"), F.count("_value").alias("_distinct"), *sums)
    state = state.withColumns({"_low": F.expr("(_total + 1) div 2"), "_high": F.expr("_total div 2 + 1")})
    state = state.withColumn("_missed", ~F.expr("_below < _low and _below + _within >= _high"))
    values = folded.filter("_value is not null").select(*groups, "_value", "_n")
    missed, large = state.agg(F.count_if("_missed"), F.count_if(F.col("_distinct") > RANKED)).first()
    if missed or large:
        state = written(state, "median-state")
    if missed:
        lost = state.filter("_missed").select(*groups)
        again = rows.join(lost, groups, "left_semi").groupBy(*groups, "_value").agg(F.count("*").alias("_n"))
        values = written(values.join(lost, groups, "left_anti").unionByName(again), "median-values")
        sizes = values.groupBy(*groups).agg(F.count("*").alias("_size"))
        state = written(
            state.join(sizes, groups, "left").withColumns(
                {"_below": F.when(F.col("_missed"), 0).otherwise(F.col("_below")), "_distinct": F.coalesce("_size", F.lit(0))}
            ).drop("_size"),
            "median-state",
        )
        large = state.filter(F.col("_distinct") > RANKED).count()
    turn = 0
    while large:
        values, state = _narrowed(values, state, groups, turn)
        large, turn = state.filter(F.col("_distinct") > RANKED).count(), turn + 1
    running = Window.partitionBy(*groups).orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.join(state, groups).withColumn("_rank", F.col("_below") + F.sum("_n").over(running))
    low, high = (F.min(F.when(F.col("_rank") >= F.col(c), F.col("_value"))).cast("double") for c in ("_low", "_high"))
    return ranked.groupBy(*by).agg(
        exact_mean(F.first("_grand"), F.first("_total")).alias("avg_loss"),
        ((low + high) / 2).alias("median_loss"),
        F.first("_grand").alias("total_loss"),
        F.coalesce(F.first("_total"), F.lit(0)).alias("n"),
    )


def _salted(values: DataFrame, brackets: DataFrame, groups: list[str]) -> DataFrame:
    """The distinct values of the groups with their brackets; a group is spread over SALTS keys of the join."""
    salted = values.withColumn("_salt", F.pmod(F.xxhash64("_value"), F.lit(SALTS)))
    every = brackets.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(every, [*groups, "_salt"]).drop("_salt")


def _narrowed(values: DataFrame, state: DataFrame, groups: list[str], turn: int) -> tuple[DataFrame, DataFrame]:
    """Cut the values of each large group at about CUTS of them and keep the cells that hold a middle rank.

    The cuts are the values whose hash falls in one of as many slots as leave about CUTS of them; each turn draws anew. Counts
    per cell are exact, so whatever the cuts are, the kept cells hold the middle.
    """
    facts = ["_below", "_low", "_high"]
    large = state.filter(F.col("_distinct") > RANKED)
    rows = values.join(large.select(*groups, "_distinct", *facts), groups)
    slots = F.ceil(F.col("_distinct") / CUTS)
    cuts = rows.filter(F.pmod(F.xxhash64("_value", F.lit(turn)), slots) == 0)
    cuts = cuts.groupBy(*groups).agg(F.sort_array(F.collect_list("_value")).alias("_cuts"))
    cell = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut <= F.col("_value"))), F.lit(0))
    rows = rows.join(cuts, groups, "left").select(*groups, "_value", "_n", *facts, cell.alias("_cell"))
    cells = rows.groupBy(*groups, "_cell").agg(
        F.sum("_n").alias("_n"), F.count("*").alias("_distinct"), *[F.first(c).alias(c) for c in facts]
    )
    before = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("_upto", F.col("_below") + F.sum("_n").over(before))  # a row per cell: about CUTS of a group
    kept = written(cells.filter("_upto >= _low and _upto - _n < _high"), "median-cells")
    facts_now = kept.groupBy(*groups).agg(F.min(F.expr("_upto - _n")).alias("_below"), F.sum("_distinct").alias("_distinct"))
    narrowed = rows.join(kept.select(*groups, "_cell"), [*groups, "_cell"], "left_semi").select(*groups, "_value", "_n")
    small = state.filter(F.col("_distinct") <= RANKED)
    others = values.join(large.select(*groups), groups, "left_anti").select(*groups, "_value", "_n")
    state = small.unionByName(large.drop("_below", "_distinct").join(facts_now, groups))
    return written(others.unionByName(narrowed), "median-values"), written(state, "median-state")


def loss_profile(df: DataFrame, key: str, measure: str = "dollar_loss", approx: int | None = None) -> DataFrame:
    """Mean, median, total and count per key; `approx` trades the exact median for a sketch of that accuracy."""
    if approx is None:
        return median_profile(df, [key], measure)
    return (
        df.filter(F.col(key).isNotNull() & F.col(measure).isNotNull())
        .groupBy(key)
        .agg(
            exact_mean(F.sum(measure), F.count("*")).alias("avg_loss"),
            F.percentile_approx(measure, 0.5, approx).cast("double").alias("median_loss"),
            F.sum(measure).alias("total_loss"),
            F.count("*").alias("n"),
        )
    )


def slice_stats(df: DataFrame, measure: str = "dollar_loss") -> DataFrame:
    return median_profile(df, [], measure)


def compare_stats(df: DataFrame, condition: Column, measure: str = "dollar_loss") -> DataFrame:
    """The same profile for a slice and for everything, from one pass; always two rows.

    A row of the slice counts in both groups; its copy meets the partial aggregation in the same
    task.
    """
    flagged = df.withColumn("_in", F.coalesce(condition, F.lit(False)))
    groups = F.when(F.col("_in"), F.array(F.lit("slice"), F.lit("all"))).otherwise(F.array(F.lit("all")))
    profile = median_profile(flagged.withColumn("scope", F.explode(groups)), ["scope"], measure)
    scopes = literal_dim(df.sparkSession, [("slice",), ("all",)], "scope string")
    return left_dim(scopes, F.broadcast(profile), "scope").na.fill(0, ["n"])  # two rows at most


def share_of_parent(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("n"), F.count("*").alias("parent_n")).withColumn(
        "pct", share_pct("n", "parent_n")
    )


# ---------------------------------------------------------------- brackets


def bracket_dist(
    df: DataFrame, measure: str = "dollar_loss", edges: Sequence[float] = LOSS_EDGES, labels: Sequence[str] = LOSS_LABELS
) -> DataFrame:
    """Count and percent per bracket, in order, empty brackets included: one aggregate row, unfolded."""
    number = bracket_no(measure, edges)
    counts = df.agg(*[F.count_if(number == i).alias(f"_{i}") for i in range(1, len(labels) + 1)])
    cells = [
        F.struct(F.lit(i).alias("bracket_no"), F.lit(label).alias("bracket"), F.col(f"_{i}").alias("n"))
        for i, label in enumerate(labels, 1)
    ]
    total = sum((F.col(f"_{i}") for i in range(2, len(labels) + 1)), F.col("_1"))
    unfolded = counts.select(total.alias("_total"), F.inline(F.array(*cells)))
    return unfolded.withColumn("pct", share_pct("n", "_total")).drop("_total")


def bracket_tail(dist: DataFrame, tails: dict[str, Sequence[str]]) -> DataFrame:
    """Totals over named sets of brackets; `dist` comes from `bracket_dist`."""
    picks = []
    for name, labels in tails.items():
        hit = F.col("bracket").isin(list(labels))
        picks.append(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"{name}_n"))
    out = dist.agg(*picks, F.sum("n").alias("_total"))
    return out.withColumns({f"{name}_pct": share_pct(f"{name}_n", "_total") for name in tails}).drop("_total")


# ---------------------------------------------------------------- rates and comparisons


def per_capita(df: DataFrame, dim: DataFrame, key: str, min_count: int = 0, name: str = "n") -> DataFrame:
    """Count per region with its population and its rate; regions without a population go."""
    counts = freq(df, key, name).filter(F.col(name) > min_count)
    return left_dim(counts, dim, key).filter("population is not null").withColumn(
        "rate_per_100k", rate_per(name, "population")
    )


def pooled_rate(df: DataFrame, dim: DataFrame, key: str, keys: Sequence) -> DataFrame:
    """Sum of counts over sum of populations, for the chosen regions."""
    return (
        left_dim(freq(keep_in(df, key, keys), key), dim, key)
        .filter("population is not null")
        .agg(F.sum("n").alias("n"), F.sum("population").alias("population"))
        .withColumn("rate_per_100k", rate_per("n", "population"))
    )


def slice_vs_all(df: DataFrame, condition: Column, key: str) -> DataFrame:
    """Per key: rows in the slice and rows overall, in one pass; keys the slice lacks are left out."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count_if(condition).alias("slice_n"), F.count("*").alias("all_n"))
        .filter("slice_n > 0")
    )


def rate_ratio(df: DataFrame, condition: Column, key: str, slice_population_k: Column, all_population_k: Column) -> DataFrame:
    """Specialisation: rate of the slice per category over the overall rate of the category."""
    return (
        slice_vs_all(df, condition, key)
        .withColumn("slice_rate", rate_per("slice_n", slice_population_k))
        .withColumn("all_rate", rate_per("all_n", all_population_k))
        .withColumn("rate_ratio", F.try_divide("slice_rate", "all_rate"))
    )


def contribution(df: DataFrame, condition: Column, key: str) -> DataFrame:
    """What percent of each category comes from the slice."""
    return slice_vs_all(df, condition, key).withColumn("share_pct", share_pct("slice_n", "all_n"))


def period_change(df: DataFrame, key: str, period: Column, before, after) -> DataFrame:
    """Count per category in two periods and the change between them; no base, no row."""
    return (
        df.filter(F.col(key).isNotNull() & period.isin(before, after))
        .groupBy(key)
        .agg(F.count_if(period == before).alias("n_before"), F.count_if(period == after).alias("n_after"))
        .filter("n_before > 0")
        .withColumn("change_pct", change_pct("n_before", "n_after"))
    )


def rate_trend(df: DataFrame, dim: DataFrame, key: str, keys: Sequence, day: str = "date") -> DataFrame:
    """Yearly count and rate for several regions, in one grouping."""
    counts = keep_in(df, key, keys).groupBy(key, F.year(day).alias("year")).agg(F.count("*").alias("n"))
    return left_dim(counts, dim, key).withColumn("rate_per_100k", rate_per("n", "population"))


def tag_counts(df: DataFrame, tags: str, separator: str = ",") -> DataFrame:
    is_list = dict(df.dtypes)[tags].startswith("array")
    exploded = df.select(F.explode(F.col(tags) if is_list else F.split(tags, re.escape(separator))).alias("tag"))
    return freq(exploded, "tag")


def with_month(df: DataFrame) -> DataFrame:
    """Add the first day of the month to a (year, month) table."""
    return df.withColumn("month_date", month_start("year", "month"))


def positive_brackets(df: DataFrame, measure: str = "dollar_loss") -> DataFrame:
    return bracket_dist(positive(df, measure), measure)
