"""Documents to chunks, chunks to vectors, vectors to nearest chunks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..functions.parsing import column, let


def words_of(c: Column | str) -> Column:
    return F.split(F.trim(F.regexp_replace(column(c), r"\s+", " ")), " ")


def chunks(df: DataFrame, key: str, text: str, size: int = 200, overlap: int = 20) -> DataFrame:
    """Overlapping word windows over the whole text; a narrow step, no shuffle.

    The last window ends with the text, so no window is a part of the one before it.
    """
    step = size - overlap

    def windows(words: Column) -> Column:
        count = F.greatest(F.ceil((F.size(words) - overlap) / F.lit(step)), F.lit(1)).cast("int")
        starts = F.sequence(F.lit(0), count - 1)
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i * step + 1, size), " "))

    texts = df.filter(F.trim(text) != "")
    return texts.select(key, F.posexplode(let(words_of(text), windows)).alias("chunk_no", "chunk"))


def term_slots(c: Column | str, dim: int) -> Column:
    """Each word's slot in the vector, from its MD5 so that any engine gets the same."""
    return F.transform(
        words_of(F.lower(column(c))),
        lambda w: F.conv(F.left(F.md5(w.cast("binary")), F.lit(8)), 16, 10).cast("bigint") % dim,
    )


def encode(c: Column | str, dim: int = 64) -> Column:
    """Hashed term counts as a float vector; the counting is one numpy call per Arrow batch."""

    @F.arrow_udf(ArrayType(FloatType()))
    def count_slots(slots: pa.Array) -> pa.Array:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(slots), 0))
        rows = np.repeat(np.arange(len(slots)), sizes)
        flat = np.asarray(slots.flatten(), dtype=np.int64)
        counted = np.bincount(rows * dim + flat, minlength=len(slots) * dim).astype(np.float32)
        offsets = np.arange(0, (len(slots) + 1) * dim, dim, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counted))

    return count_slots(term_slots(c, dim))


def index_documents(df: DataFrame, key: str, text: str, size: int = 200, overlap: int = 20, dim: int = 64) -> DataFrame:
    """(document, chunk number, chunk text, vector)."""
    return chunks(df, key, text, size, overlap).withColumn("embedding", encode("chunk", dim))


def _matcher(query_id: str, ids: list[str], vector: str, k: int):
    """Functions that score a block of rows against queries and keep the k best per query.

    They are nested so that they travel to the workers by value; the package need not be installed
    there.
    """

    def matrix(vectors) -> np.ndarray:
        return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])

    def scores_of(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Cosine of every query with every row, rounded so that equal vectors tie."""
        norms = np.sqrt((asked**2).sum(axis=1))[:, None] * np.sqrt((rows**2).sum(axis=1))[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.round(np.where(norms > 0, (asked @ rows.T) / norms, 0.0), 9)

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        ranked = frame.sort_values([query_id, "score", *ids], ascending=[True, False, *[True] * len(ids)])
        return ranked.groupby(query_id, sort=False).head(k)

    def local_top(names, asked: np.ndarray, batch: pd.DataFrame) -> pd.DataFrame:
        """Best rows of one batch; the score matrix is built for 256 queries at a time."""
        rows, names, parts = matrix(batch[vector]), np.asarray(names), []
        for start in range(0, len(names), 256):
            scores = scores_of(asked[start : start + 256], rows)
            if scores.shape[1] > k:
                hits = scores >= np.partition(scores, -k, axis=1)[:, -k, None]
            else:
                hits = np.ones(scores.shape, dtype=bool)
            query_no, row_no = np.nonzero(hits)
            found = batch[ids].iloc[row_no]
            parts.append(best(found.assign(**{query_id: names[start + query_no], "score": scores[query_no, row_no]})))
        return pd.concat(parts)

    return matrix, best, local_top


def retrieve(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    ids: list[str],
    query_id: str = "query_id",
    vector: str = "embedding",
    block_queries: int = 4096,
    block_rows: int = 20000,
) -> DataFrame:
    """The k most similar rows per query by exact cosine; ties go to the smaller id.

    Both sides are cut into hashed blocks of bounded size (two counts decide how many), each pair of blocks
    is one group, scored as a matrix product, and only k rows per query leave a group. Every vector is sent
    once per block of queries, so few queries mean one pass. Rows and queries without a vector are left out.
    """
    vectors, queries = vectors.filter(F.col(vector).isNotNull()), queries.filter(F.col(vector).isNotNull())
    id_type = {f.name: f.dataType.simpleString() for f in (*vectors.schema, *queries.schema)}
    schema = ", ".join(f"`{c}` {id_type[c]}" for c in [*ids, query_id]) + ", score double"
    order = [*ids, query_id, "score"]
    matrix, best, local_top = _matcher(query_id, ids, vector, k)
    query_blocks = max(1, -(-queries.count() // block_queries))
    vector_blocks = max(1, -(-vectors.count() // block_rows))
    left = (
        vectors.select(*ids, vector)
        .withColumn("_v", F.pmod(F.xxhash64(*ids), F.lit(vector_blocks)))
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>")))
    )
    right = (
        queries.select(query_id, vector)
        .withColumn("_q", F.pmod(F.xxhash64(query_id), F.lit(query_blocks)))
        .withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1)).cast("array<bigint>")))
    )

    def match(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({c: pd.Series(dtype=object) for c in order})
        return local_top(asked[query_id], matrix(asked[vector]), rows)[order]

    local = left.groupBy("_q", "_v").cogroup(right.groupBy("_q", "_v")).applyInPandas(match, schema)
    ranked = Window.partitionBy(query_id).orderBy(F.col("score").desc(), *ids)
    return local.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
