from __future__ import annotations

import random
import statistics
from decimal import Decimal

import pytest
from conftest import final_plan, plan_of
from pyspark.sql import functions as F

from reportloom.operators import aggregates, joins, reshape
from reportloom.sources.tables import complaints


def random_losses(spark, n, seed=3):
    rng = random.Random(seed)
    # One group holds well over a third of the rows, and one value is very frequent.
    rows = [
        (rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.choice([None, Decimal("50.00"), Decimal(rng.randint(1, 5000000)) / 100]))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, "g string, dollar_loss decimal(18,2)")


@pytest.mark.parametrize("n", [0, 1, 2, 7, 400, 401, 30001])
def test_median_is_exact(spark, n):
    rows, df = random_losses(spark, n)
    groups = {}
    for g, v in rows:
        if g is not None and v is not None:
            groups.setdefault(g, []).append(float(v))
    got = {r.g: r for r in aggregates.median_profile(df, ["g"], "dollar_loss").collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert got[g].n == len(vs) and got[g].median_loss == pytest.approx(statistics.median(vs))
        assert float(got[g].total_loss) == pytest.approx(sum(vs)) and got[g].avg_loss == pytest.approx(statistics.mean(vs))


def test_global_and_compared_medians(spark):
    rows, df = random_losses(spark, 301)
    vs = [float(v) for _, v in rows if v is not None]
    hot = [float(v) for g, v in rows if g == "hot" and v is not None]
    assert aggregates.slice_stats(df).first().median_loss == pytest.approx(statistics.median(vs))
    both = {r.scope: r for r in aggregates.compare_stats(df, F.col("g") == "hot").collect()}
    assert both["slice"].median_loss == pytest.approx(statistics.median(hot)) and both["slice"].n == len(hot)
    assert both["all"].median_loss == pytest.approx(statistics.median(vs)) and both["all"].n == len(vs)


def test_profiles_of_nothing(spark):
    _, df = random_losses(spark, 0)
    assert tuple(aggregates.slice_stats(df).first()) == (None, None, None, 0)
    assert sorted((r.scope, r.n) for r in aggregates.compare_stats(df, F.lit(True)).collect()) == [("all", 0), ("slice", 0)]


def test_approximate_median_option(spark):
    rows, df = random_losses(spark, 400)
    hot = [float(v) for g, v in rows if g == "hot" and v is not None]
    got = {r.g: r for r in aggregates.loss_profile(df, "g", approx=10000).collect()}
    assert sorted(hot)[len(hot) // 4] <= got["hot"].median_loss <= sorted(hot)[3 * len(hot) // 4]


def test_medians_of_doubles(spark):
    nan = float("nan")
    groups = {"nan": [20000.0, 30000.0, nan], "all_nan": [nan, nan], "mostly_nan": [1.0, nan, nan], "small": [i / 1e4 for i in range(777)], "large": [1e30 * i for i in range(1, 6)], "inf": [1.0, float("inf"), float("inf")], "mixed": [-1e300, 0.0, 1e-300, 5.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r.g: r for r in aggregates.median_profile(df, ["g"], "v").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    for g, vs in groups.items():
        assert got[g].n == len(vs) and got[g].median_loss == pytest.approx(want[g], nan_ok=True), g
    assert aggregates.slice_stats(df.filter("g = 'large'"), "v").first().median_loss == pytest.approx(3e30)


@pytest.fixture
def steps(monkeypatch):
    """Every table that the medians write, by name, with the plan that made it."""
    found = []

    def recorded(df, name, write=aggregates.written):
        out = write(df, name)
        found.append((name, plan_of(df), out))
        return out

    monkeypatch.setattr(aggregates, "written", recorded)
    return found


def test_medians_scan_twice_and_rank_a_few(spark, sf_dir, tmp_path, steps):
    path = str(tmp_path / "base-table")
    spark.range(200_000).selectExpr("id % 3 AS g", "CAST(hash(id) AS DOUBLE) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    profile = aggregates.median_profile(df, ["g"], "v")
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r.g: r.median_loss for r in profile.collect()} == want
    plan = final_plan(profile)
    base = "ReadSchema: struct<g:bigint,v:double>"
    assert plan.count("FileScan") == 2 and "Collect" not in plan and base not in plan
    ((name, made, _),) = steps
    assert name == "median-values" and made.split("== Initial Plan ==")[0].count(base) == 2


BRACKETS = {
    "below": lambda v: F.array(F.min(v), F.min(v)),
    "above": lambda v: F.array(F.max(v), F.max(v)),
    "all": lambda v: F.array(F.min(v), F.max(v)),
    "upper half": lambda v: F.array(F.percentile_approx(v, 0.6), F.max(v)),
}


@pytest.mark.parametrize("bracket", sorted(BRACKETS))
def test_medians_do_not_rest_on_the_sketch(spark, monkeypatch, steps, bracket):
    """Whatever the sketch says, the median is right, and no task ranks more values than stated."""
    monkeypatch.setattr(aggregates, "middle_bracket", BRACKETS[bracket])
    monkeypatch.setattr(aggregates, "RANKED", 40)
    monkeypatch.setattr(aggregates, "CUTS", 6)
    rng = random.Random(5)
    groups = {"many": [rng.gauss(0, 1) for _ in range(3000)], "even": [float(i) for i in range(900)] * 2, "one": [7.0], "two": [1.0, 2.0]}
    groups |= {"flat": [3.0] * 500, "skew": [rng.paretovariate(0.3) for _ in range(1001)], "odd": [float("nan"), float("inf"), 0.0, -0.0, 1e-300] * 30}
    rows = [(g, v, Decimal(repr(v)) if abs(v) < 1e12 else None) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double, m decimal(28,6)").repartition(5)
    for measure in ("v", "m"):
        steps.clear()
        profile = aggregates.median_profile(df, ["g"], measure)
        assert max(r["_distinct"] for r in [s for name, _, s in steps if name == "median-state"][-1].collect()) <= 40
        got = {r.g: (r.median_loss, r.n) for r in profile.collect()}
        want = {r.g: (r.median, r.n) for r in df.filter(f"{measure} is not null").groupBy("g").agg(F.median(measure).alias("median"), F.count("*").alias("n")).collect()}
        assert got.keys() == want.keys()
        for g in want:
            assert got[g][1] == want[g][1] and got[g][0] == pytest.approx(float(want[g][0]), nan_ok=True), (g, measure)
    whole = aggregates.slice_stats(df, "v").first()
    assert whole.median_loss == pytest.approx(df.agg(F.median("v")).first()[0]) and whole.n == len(rows)


def test_sparse_cross_is_completed(spark):
    pairs = [("x", "p"), ("x", "q"), ("x", "q"), ("y", "p"), ("y", "r"), (None, "p")]
    df = spark.createDataFrame(pairs, "a string, b string")
    dense = joins.complete(aggregates.cross_freq(df, "a", "b"), "a", "b")
    got = {(r.a, r.b): r.n for r in dense.collect()}
    assert got == {("x", "p"): 1, ("x", "q"): 2, ("x", "r"): 0, ("y", "p"): 1, ("y", "q"): 0, ("y", "r"): 1}


def test_dense_grid_reads_its_input_once(spark, sf_dir):
    cells = aggregates.cross_freq(complaints(spark, sf_dir, "age_range", "fraud_cat"), "age_range", "fraud_cat")
    dense = joins.complete(cells, "age_range", "fraud_cat")
    dense.collect()
    plan = plan_of(dense)
    # the tile counts are subqueries; they and the join take the shuffle of the cells again
    assert "ReusedExchange" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_grid_is_complete_for_many_levels(spark):
    left, right = spark.range(37).withColumnRenamed("id", "a"), spark.range(53).withColumnRenamed("id", "b")
    for cells in (1, 40, 1_000_000):
        assert joins.grid(left, right, cells).distinct().count() == 37 * 53
    assert joins.grid(left, right.limit(0)).count() == 0


def test_brackets_partition_positive_values(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in "0 0.01 100 100.01 500 10000.01".split()] + [(None,)], "dollar_loss decimal(18,2)")
    dist = aggregates.positive_brackets(df)
    rows = dist.orderBy("bracket_no").collect()
    assert [r.n for r in rows] == [2, 2, 0, 0, 0, 1] and sum(r.pct for r in rows) == pytest.approx(100)
    tails = aggregates.bracket_tail(dist, {"high": [">$10000"], "low": ["$1-100", "$101-500"]}).first()
    assert (tails.high_n, tails.low_n) == (1, 4) and tails.low_pct == pytest.approx(80)


def test_empty_brackets(spark):
    rows = aggregates.positive_brackets(spark.createDataFrame([], "dollar_loss decimal(18,2)")).collect()
    assert [r.n for r in rows] == [0] * 6 and {r.pct for r in rows} == {None}


def test_period_change_skips_zero_base(spark):
    df = spark.createDataFrame([("a", 1)] * 4 + [("a", 2)] + [("b", 2)] * 3 + [("c", 1)], "k string, y int")
    got = {r.k: r.change_pct for r in aggregates.period_change(df, "k", F.col("y"), 1, 2).collect()}
    assert got == {"a": -75.0, "c": -100.0}


def test_rollup_levels_agree(spark, sf_dir):
    rows = complaints(spark, sf_dir, "date", "dollar_loss", "num_victims")
    direct = rows.agg(F.sum("dollar_loss"), F.sum("num_victims")).first()
    for summary in (aggregates.monthly_summary(rows), aggregates.yearly_summary(rows)):
        assert summary.agg(F.sum("total_loss"), F.sum("total_victims")).first() == direct


def test_population_table(spark):
    dim = joins.province_population(spark)
    assert dim.count() == 13 and dim.filter("province = 'Quebec'").first().population == 8751.0


def test_semi_topk_with_null_place(spark):
    totals = spark.createDataFrame([(None, 9), ("a", 5), ("b", 5), ("c", 1)], "k string, total int")
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    assert sorted(r.k for r in joins.semi_topk(rows, "k", totals, "total", 2).collect()) == ["a"]


def test_tag_counts(spark):
    df = spark.createDataFrame([("R,Spark",), ("Spark",), (None,)], "tags string")
    assert {r.tag: r.n for r in aggregates.tag_counts(df, "tags").collect()} == {"R": 1, "Spark": 2}


def test_tags_are_split_literally(spark):
    df = spark.createDataFrame([("ab|cd",), ("cd|ab|ab",)], "tags string")
    assert {r.tag: r.n for r in aggregates.tag_counts(df, "tags", "|").collect()} == {"ab": 3, "cd": 2}


def test_reshape(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "a", 3)], "i string, c string, v int")
    wide = reshape.widen(df, "i", "c", "v", ["b", "a"])
    assert wide.columns == ["i", "b", "a"] and {tuple(r) for r in wide.collect()} == {("x", 2, 1), ("y", 0, 3)}
    nulls = reshape.widen_null(df, "i", "c", "v", ["a", "b"], prefix="c_")
    assert nulls.columns == ["i", "c_a", "c_b"] and {tuple(r) for r in nulls.collect()} == {("x", 1, 2), ("y", 3, None)}
    assert reshape.lengthen(wide, ["i"], ["a", "b"]).count() == 4
    assert reshape.stack(df, df.drop("v")).count() == 6


@pytest.mark.parametrize("few", [None, 1])
def test_no_task_reads_a_group_to_meet_its_bracket(spark, monkeypatch, steps, few):
    """Rows meet a row per group without a shuffle; with very many groups, distinct values do in SALTS parts of a group."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if few:
            monkeypatch.setattr(aggregates, "FEW_GROUPS", few)
        df = spark.createDataFrame([(i % 2 == 0, float(i % 701)) for i in range(3000)], "hot boolean, v double")
        got = {r.scope: (r.median_loss, r.n) for r in aggregates.compare_stats(df, F.col("hot"), "v").collect()}
        made = steps[0][1]
        assert ("_salt" in made) if few else ("SortMergeJoin" not in made)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {"all": [float(i % 701) for i in range(3000)], "slice": [float(i % 701) for i in range(0, 3000, 2)]}
    assert got == {scope: (statistics.median(vs), len(vs)) for scope, vs in want.items()}
