"""Exact nearest vectors from a stored index of cells: most cells are ruled out by a bound and never read.

Every vector lies in the cell of its most similar centre, and each cell knows the widest angle between its centre and
one of its vectors. A question at angle a from the centre of a cell of radius r is at an angle of at least a - r from all of
the cell's vectors (triangle inequality on the sphere), so cos(a - r) bounds their scores. A question first opens the cells
of greatest bound that hold k vectors; the k-th best score found there is its threshold, and of the other cells only those
whose bound reaches the threshold are opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..workspace import written
from .retrieval import _matcher

CELL_ROWS = 4096  # vectors a cell should hold
MOST_CELLS = 4096  # rows of the table of cells, which every task that plans questions holds
CENTRE_BYTES = 16 << 20  # size of their centres; long vectors mean fewer cells
SAMPLE_PER_CELL = 24  # vectors looked at for each centre
SAMPLE_BYTES = 64 << 20  # and the size of all of them, which the driver holds
ROUNDS = 4  # of moving the centres to the mean of their sample
NO_DIRECTION = -1  # cell of vectors of length zero, whose score is 0
SLACK = 1e-8  # scores are rounded to nine places and angles have rounding errors; bounds are raised by this


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column (all of one length, no null) as float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows scaled to length 1, whether a row has a length)."""
    norms = np.sqrt((rows**2).sum(axis=1))
    some = norms > 0
    return rows / np.where(some, norms, 1)[:, None], some


def _centres(vectors: DataFrame, vector: str, n: int, dim: int, cells: int, seed: int) -> np.ndarray:
    """Unit centres from a bounded sample: at most SAMPLE_PER_CELL vectors a cell, and SAMPLE_BYTES, reach the driver."""
    wanted = max(cells, min(cells * SAMPLE_PER_CELL, SAMPLE_BYTES // (8 * dim)))
    sample = vectors.select(vector).sample(min(1.0, 1.2 * wanted / n), seed=seed).limit(wanted).toArrow()
    units, some = _units(_matrix(sample.column(0)))
    units = np.unique(units[some], axis=0)
    if not len(units):
        return np.zeros((0, units.shape[1]))
    centres = units[np.random.default_rng(seed).permutation(len(units))[:cells]]
    for _ in range(ROUNDS):
        nearest = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(units, -(-len(units) // 8192))])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        moved, some = _units(sums)
        centres = np.where(some[:, None], moved, centres)
    return centres


def write_cells(
    vectors: DataFrame, path: str, ids: list[str], vector: str = "embedding", cells: int | None = None, seed: int = 1
) -> None:
    """Store `ids` and `vector` by cell below `path`; an index that is there already is replaced.

    `vectors` is read three times (count, sample, assignment). The centres come from a bounded sample and only decide how
    well cells prune; every row with a vector is stored, in files sorted by cell, so that a filter on cells skips files and
    row groups. A cell may hold any share of all rows: its rows are spread over tasks by AQE when they are written, and over
    blocks when they are searched. Rows without a vector are left out.
    """
    spark = vectors.sparkSession
    known = vectors.filter(F.col(vector).isNotNull()).select(*ids, vector)
    n, dim = known.agg(F.count("*"), F.max(F.size(vector))).first()
    wanted = max(1, min(MOST_CELLS, CENTRE_BYTES // (8 * max(1, dim or 1)), cells or -(-n // CELL_ROWS)))
    centres = _centres(known, vector, n, max(1, dim), wanted, seed) if n else np.zeros((0, 0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, some = _units(_matrix(batch.column(len(ids))))
            cell, cosine = np.full(len(units), NO_DIRECTION, np.int32), np.zeros(len(units))
            if len(centres) and len(units):
                scores = units @ centres.T
                best = scores.argmax(axis=1)
                cell = np.where(some, best, NO_DIRECTION).astype(np.int32)
                cosine = np.where(some, np.clip(scores[np.arange(len(units)), best], -1, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(cosine)], [*batch.schema.names, "cell", "cosine"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.schema)
    placed = known.mapInArrow(assign, f"{fields}, cell int, cosine double")
    # a cell's rows are cut by id as well, so a cell that holds most rows is many ranges
    placed.repartitionByRange("cell", F.xxhash64(*ids)).sortWithinPartitions("cell").write.mode("overwrite").parquet(f"{path}/vectors")
    stored = spark.read.parquet(f"{path}/vectors")
    sizes = stored.groupBy("cell").agg(F.count("*").alias("n"), F.min("cosine").alias("least_cosine"))
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)] + [(NO_DIRECTION, [])]
    table = spark.createDataFrame(rows, "cell int, centre array<double>")
    sizes.join(table, "cell").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")  # MOST_CELLS rows at most


class _Plan:
    """Bounds of all cells for a block of questions."""

    def __init__(self, cells: list):
        cells = sorted(cells, key=lambda c: c["cell"])
        self.cell = np.array([c["cell"] for c in cells], np.int32)
        self.n = np.array([c["n"] for c in cells], np.int64)
        directed = [c for c in cells if c["cell"] != NO_DIRECTION]
        self.centres = np.array([c["centre"] for c in directed], np.float64)
        self.radius = np.arccos(np.clip(np.array([c["least_cosine"] for c in directed], np.float64), -1, 1))

    def bounds(self, asked: np.ndarray) -> np.ndarray:
        """(questions x cells) greatest score that a vector of the cell can have."""
        units, some = _units(asked)
        out = np.zeros((len(asked), len(self.cell)))
        if len(self.centres):
            angle = np.arccos(np.clip(units @ self.centres.T, -1, 1)) - self.radius
            directed = np.where(angle > 0, np.cos(np.minimum(angle, np.pi)), 1.0)
            out[:, self.cell != NO_DIRECTION] = np.where(some[:, None], directed, 0.0)
        return out + SLACK

    def first(self, bounds: np.ndarray, k: int) -> np.ndarray:
        """Cells that a question opens first: the greatest bounds, until they hold k vectors."""
        order = np.argsort(-bounds, axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        out = np.zeros(bounds.shape, bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out


def cells_to_open(asked: DataFrame, cells: list, k: int, vector: str, threshold: str | None = None) -> DataFrame:
    """The questions, once per cell that they open: the first ones, or with a threshold column those left that reach it."""
    names = [c for c in asked.columns if c != threshold]
    place = asked.columns.index(vector)
    least_place = None if threshold is None else asked.columns.index(threshold)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = _Plan(cells)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                bounds = plans.bounds(_matrix(batch.column(place)))
                wanted = plans.first(bounds, k)
                if least_place is not None:
                    least = np.asarray(batch.column(least_place).to_numpy(zero_copy_only=False), np.float64)
                    # without k scores so far (null) every cell can matter
                    wanted = ~wanted & ~(bounds < least[:, None])
                question, cell = np.nonzero(wanted)
                kept = batch.select(names).take(pa.array(question))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(plans.cell[cell])], [*names, "cell"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema if f.name != threshold)
    return asked.mapInArrow(plan, f"{fields}, cell int")


def read_cells(spark: SparkSession, path: str) -> list:
    """One row per cell: cell, n, least_cosine, centre; at most MOST_CELLS."""
    return spark.read.parquet(f"{path}/cells").collect()


def retrieve_from_cells(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int,
    ids: list[str],
    query_id: str = "query_id",
    vector: str = "embedding",
    block_queries: int = 4096,
    block_rows: int = 20000,
) -> DataFrame:
    """The k most similar rows per query from the index below `path`: the rows and ranks of `retrieve`, from few cells.

    Scores are those of `retrieve` (cosine, nine places, ties to the smaller id; 0 with a vector of length zero). Only
    questions move between the steps; a cell's vectors are read for the questions that open it, in blocks of `block_rows`
    vectors and `block_queries` questions.
    """
    cells = read_cells(spark, path)
    stored = spark.read.parquet(f"{path}/vectors")
    asked = queries.filter(F.col(vector).isNotNull()).select(query_id, vector)
    first = _best_in_cells(stored, cells_to_open(asked, cells, k, vector), cells, k, ids, query_id, vector, block_queries, block_rows)
    first = written(first, "first-cells")  # at most k rows a question, which both later steps need
    least = first.groupBy(query_id).agg(F.when(F.count("*") >= k, F.min("score")).alias("_least"))
    rest = cells_to_open(asked.join(least, query_id, "left"), cells, k, vector, "_least")
    more = _best_in_cells(stored, rest, cells, k, ids, query_id, vector, block_queries, block_rows)
    return _top(first.unionByName(more), k, ids, query_id)


def _top(df: DataFrame, k: int, ids: list[str], query_id: str) -> DataFrame:
    ranked = Window.partitionBy(query_id).orderBy(F.col("score").desc(), *ids)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def _best_in_cells(
    stored: DataFrame, opened: DataFrame, cells: list, k: int, ids: list[str], query_id: str, vector: str, block_queries: int, block_rows: int
) -> DataFrame:
    """The k best rows a question has in the cells that it opens; only these leave a group of cell and blocks."""
    spark = stored.sparkSession
    parts = spark.createDataFrame(
        [(c["cell"], max(1, -(-c["n"] // block_rows))) for c in cells], "cell int, _parts long"
    )
    sizes = opened.groupBy("cell").agg(F.ceil(F.count("*") / block_queries).cast("long").alias("_blocks"))
    # both tables have a row per cell, MOST_CELLS at most
    layout = F.broadcast(sizes.join(F.broadcast(parts), "cell"))
    rows = stored.select("cell", *ids, vector).join(layout, "cell")
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*ids), F.col("_parts"))).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    ).drop("_parts", "_blocks")
    asked = opened.join(layout, "cell")
    asked = asked.withColumn("_block", F.pmod(F.xxhash64(query_id), F.col("_blocks"))).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
    ).drop("_parts", "_blocks")
    types = {f.name: f.dataType.simpleString() for f in (*stored.schema, *opened.schema)}
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*ids, query_id]) + ", score double"
    order = [*ids, query_id, "score"]
    matrix, _, local_top = _matcher(query_id, ids, vector, k)

    def match(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({c: pd.Series(dtype=object) for c in order})
        return local_top(asked[query_id], matrix(asked[vector]), rows)[order]

    keys = ["cell", "_part", "_block"]
    found = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(match, schema)
    return _top(found, k, ids, query_id).drop("rank")
