"""Clustering. Labels depend on the random start; the SQL checks what must hold for any of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clustering import kmeans, kmeans_checks, kmeans_sweep, silhouette
from ..sources.tables import table
from .registry import query

# Cost at k = 1: summed squared distance from the means.
ONE_COST = "var_pop(p_size) * count(p_size) + var_pop(p_retailprice) * count(p_retailprice)"


def points(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")


@query("m01_kmeans")
def m01(spark, sf_dir):
    return kmeans(points(spark, sf_dir), "p_size", "p_retailprice", 3)[0]


@query("m01_kmeans_single", "SELECT p_partkey, p_size, 0 AS cluster FROM part")
def m01_single(spark, sf_dir):
    return kmeans(points(spark, sf_dir), "p_size", "p_retailprice", 1)[0].select("p_partkey", "p_size", "cluster")


@query(
    "m01_kmeans_checks",
    """SELECT 3 AS k, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_misplaced,
              true AS cost_agrees, true AS below_one_cluster FROM part""",
)
def m01_checks(spark, sf_dir):
    """Rows are at their nearest centre, and the model's cost is that of its labels and below the cost of one cluster."""
    one = points(spark, sf_dir).agg(F.var_pop("p_size") * F.count("*") + F.var_pop("p_retailprice") * F.count("*")).scalar()
    found = kmeans_checks(points(spark, sf_dir), "p_size", "p_retailprice", "p_partkey", 3)
    return found.select(
        "k", "n_rows", "n_clusters", "n_misplaced",
        (F.abs(F.col("cost") - F.col("summed_cost")) <= 1e-6 * F.col("cost")).alias("cost_agrees"),
        (F.col("cost") < one).alias("below_one_cluster"),
    )


@query(
    "m01_kmeans_centres",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(3 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_off_mean FROM part",
)
def m01_centres(spark, sf_dir):
    """Each centre is the mean of its rows, to the tolerance at which the iteration stops."""
    rows, centres, _ = kmeans(points(spark, sf_dir), "p_size", "p_retailprice", 3)
    means = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.avg("p_size").alias("a"), F.avg("p_retailprice").alias("b"))
    table_of = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in centres])
    centre = table_of[F.col("cluster")]
    off = (F.abs(F.col("a") - centre[0]) > 1.0) | (F.abs(F.col("b") - centre[1]) > 1.0)
    return means.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_clusters"), F.count_if(off).alias("n_off_mean"))


@query("m02_kmeans_sweep")
def m02(spark, sf_dir):
    return kmeans_sweep(points(spark, sf_dir), "p_size", "p_retailprice").withColumn("cost_per_k", F.col("cost") / F.col("k"))


@query(
    "m02_kmeans_sweep_checks",
    f"""SELECT CAST(k AS INTEGER) AS k, CASE WHEN k = 1 THEN round(one, 2) END AS cost_of_one, true AS not_above_one
        FROM (SELECT {ONE_COST} AS one FROM part), range(1, 10) AS r(k)""",
)
def m02_checks(spark, sf_dir):
    """One cost per k from 1 to 9: that of k = 1 is known, the others are not above it."""
    costs = kmeans_sweep(points(spark, sf_dir), "p_size", "p_retailprice")
    one = F.col("one")
    with_one = costs.withColumn("one", costs.filter("k = 1").select("cost").scalar())
    return with_one.select(
        "k", F.when(F.col("k") == 1, F.round("cost", 2)).alias("cost_of_one"), (F.col("cost") <= one * (1 + 1e-9)).alias("not_above_one")
    )


@query(
    "m02_silhouette",
    """WITH p AS (SELECT p_partkey AS id, p_brand AS label, CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y FROM part),
            means AS (SELECT a.id, a.label AS own, b.label, sum((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))
                             / nullif(count(*) - max(CASE WHEN a.label = b.label THEN 1 ELSE 0 END), 0) AS away FROM p a, p b GROUP BY ALL),
            sides AS (SELECT id, max(away) FILTER (own = label) AS a, min(away) FILTER (own <> label) AS b FROM means GROUP BY id)
       SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 8) AS silhouette, count(*) AS n FROM sides""",
)
def m02_silhouette(spark, sf_dir):
    """How well the brand of a part follows from its size and price; the SQL compares all pairs."""
    parts = table(spark, sf_dir, "part")
    return silhouette(parts, "p_size", "p_retailprice", "p_brand").select(F.round("silhouette", 8).alias("silhouette"), "n")
