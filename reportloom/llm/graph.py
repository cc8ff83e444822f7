"""Connected components of links between row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each linked node can reach, itself included.

    Alternates two contractions, each a grouped minimum and an equi-join: every node hands its smallest
    neighbour to the larger ones, then to the smaller ones. The number of rounds grows with the logarithm of
    the largest component, and a hub's rows are only ever pre-aggregated or part of a join that Spark can
    split. Null ids and self-links are ignored; without links the result is empty.
    """
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    edges = stored(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        outward = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        outward = outward.distinct()
        least = outward.groupBy("u").agg(F.min("v").alias("m"))
        inward = outward.join(least, "u")
        edges = inward.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = stored(edges.distinct(), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Tells whether a round has changed anything: count and an order-free hash of the edges."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
