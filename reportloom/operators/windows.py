"""Window reports over period tables and cross tables.

These run on aggregated rows: one row per period (and series). Without a series key the window is
a single partition, which is bounded by the number of calendar periods, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import change_pct, share_pct
from .aggregates import exact_mean


def rolling_mean(df: DataFrame, order: str, measures: dict[str, str], rows: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Trailing mean over the last `rows` rows (rows, not calendar months), from the first row on."""
    frame = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumns(
        {name: exact_mean(F.sum(measure).over(frame), F.count(measure).over(frame)) for measure, name in measures.items()}
    )


def fill_months(monthly: DataFrame, order: str, measures: Sequence[str]) -> DataFrame:
    """Add absent calendar months with zero measures, for calendar instead of row frames."""
    span = monthly.agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
    months = span.select(F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias(order))
    return months.join(monthly, order, "left").na.fill(0, list(measures))


def yoy(df: DataFrame, order: str, measure: str, by: Sequence[str] = ()) -> DataFrame:
    """Difference and percent change against the previous row; null on the first."""
    before = F.lag(measure).over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("_before", before).select(
        *df.columns,
        (F.col(measure) - F.col("_before")).alias("yoy_change"),
        change_pct("_before", measure).alias("yoy_pct_change"),
    )


def row_pct(counts: DataFrame, a: str, measure: str = "n") -> DataFrame:
    """Share of each cell within its `a` level, over all cells: call it before dropping categories."""
    return counts.withColumn("pct", share_pct(F.col(measure), F.sum(measure).over(Window.partitionBy(a))))


def pct_total(counts: DataFrame, measure: str = "n") -> DataFrame:
    """Share of the grand total, which is a scalar subquery instead of a one-partition window."""
    return counts.withColumn("pct", share_pct(F.col(measure), counts.agg(F.sum(measure)).scalar()))


def peak(df: DataFrame, measure: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """The row with the largest measure (per series); the earliest one on ties."""
    best = [F.col(measure).desc_nulls_last(), F.col(order)]
    if not by:
        return df.orderBy(*best).limit(1)
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).filter("_rank = 1").drop("_rank")


def peak_key(measure: str, order: str) -> Column:
    """Ordering value that makes `max_by` take the earliest of several peaks and skip nulls."""
    return F.when(F.col(measure).isNotNull(), F.struct(F.col(measure).alias("m"), (-F.unix_date(order)).alias("d")))


def peaks(df: DataFrame, first: str, second: str, order: str, *more: Column) -> DataFrame:
    """Peak value and date of two measures as one row, from one aggregate; `more` aggregates ride along."""
    picks = []
    for measure in (first, second):
        row = F.max_by(F.struct(F.col(measure).alias("v"), F.col(order).alias("d")), peak_key(measure, order))
        picks.append(row.alias(f"_{measure}"))
    found = df.agg(*picks, *more)
    parts = [
        F.col(f"_{measure}.{part}").alias(name)
        for measure in (first, second)
        for part, name in (("v", f"peak_{measure}"), ("d", f"peak_{measure}_date"))
    ]
    return found.select(*parts, *found.columns[2:])


def peak_divergence(df: DataFrame, first: str, second: str, order: str, *more: Column) -> DataFrame:
    """Do both measures peak in the same period?"""
    same = F.col(f"peak_{first}_date") == F.col(f"peak_{second}_date")
    return peaks(df, first, second, order, *more).withColumn(
        "divergence", F.when(same, "parallel spike").when(~same, "strong divergence")
    )


def loess(df: DataFrame, x: str, y: str, by: str | None = None, span: float = 0.75) -> DataFrame:
    """Local quadratic trend line per series, evaluated at each period.

    `df` holds one row per series and period, so a series is as long as the calendar. Around each period the
    nearest `span` of the points get tricube weights; the weighted least-squares parabola at the period itself
    comes from weighted sums in closed form (a line or a mean, where there are only two points or one). Points
    need a numeric `x`; rows with nulls are left out.

    The k nearest points are a run of the sorted series. It begins behind as many points as there are middles, between
    a point and the one k further on, that lie before the period; only the run is unfolded.
    """
    series = [by] if by else []
    points = df.select(*series, F.col(x).alias("_px"), F.col(y).alias("_py"))
    points = points.dropna().groupBy(*series).agg(F.sort_array(F.collect_list(F.struct("_px", "_py"))).alias("_all"))
    near = F.least(F.size("_all"), F.greatest(F.lit(2), F.floor(F.size("_all") * span + 1e-5).cast("int")))
    points = points.withColumn("_near", near)
    place = lambda i: F.element_at("_all", i)["_px"].cast("double")
    numbers = F.sequence(F.lit(1), F.size("_all") - F.col("_near"))
    middles = F.when(F.size("_all") > F.col("_near"), F.transform(numbers, lambda i: (place(i) + place(i + F.col("_near"))) / 2))
    points = points.withColumn("_middles", F.coalesce(middles, F.array().cast("array<double>")))
    pairs = points.select(*series, "_all", "_near", "_middles", F.posexplode("_all").alias("_no", "_at"))
    at = F.col("_at._px").cast("double")
    run = F.slice("_all", F.size(F.filter("_middles", lambda m: m < at)) + 1, F.col("_near"))
    pairs = pairs.select(*series, "_no", "_at", run.alias("_run"))
    ends = [F.abs(F.element_at("_run", i)["_px"].cast("double") - at) for i in (1, -1)]
    pairs = pairs.select(*series, "_no", "_at", F.greatest(*ends).alias("_reach"), F.explode("_run").alias("_p"))
    step = (F.col("_p._px").cast("double") - F.col("_at._px").cast("double")) / F.when(F.col("_reach") > 0, F.col("_reach")).otherwise(1.0)
    pairs = pairs.select(*series, "_no", "_at", step.alias("_d"), F.col("_p._py").cast("double").alias("_v"))
    weight = F.when(F.abs("_d") < 1, F.pow(1 - F.pow(F.abs("_d"), F.lit(3)), F.lit(3))).otherwise(0.0)
    pairs = pairs.withColumn("_w", weight)
    sums = {f"_s{i}": F.sum(F.col("_w") * F.pow("_d", F.lit(i))) for i in range(5)}
    sums |= {f"_t{i}": F.sum(F.col("_w") * F.pow("_d", F.lit(i)) * F.col("_v")) for i in range(3)}
    used = F.size(F.collect_set(F.when(F.col("_w") > 0, F.col("_d")))).alias("_used")
    found = pairs.groupBy(*series, "_no", "_at").agg(used, *[value.alias(name) for name, value in sums.items()])
    line = F.expr("(_t0 * _s2 - _s1 * _t1) / (_s0 * _s2 - _s1 * _s1)")
    parabola = F.expr(
        "(_t0 * (_s2 * _s4 - _s3 * _s3) - _s1 * (_t1 * _s4 - _s3 * _t2) + _s2 * (_t1 * _s3 - _s2 * _t2))"
        " / (_s0 * (_s2 * _s4 - _s3 * _s3) - _s1 * (_s1 * _s4 - _s3 * _s2) + _s2 * (_s1 * _s3 - _s2 * _s2))"
    )
    trend = F.when(F.col("_used") > 2, parabola).when(F.col("_used") == 2, line).otherwise(F.expr("_t0 / _s0"))
    return found.select(*series, F.col("_at._px").alias(x), F.col("_at._py").alias(y), trend.alias("trend"))
