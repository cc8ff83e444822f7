"""Documents -> vector table -> nearest chunks per question."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.retrieval import encode, index_documents, retrieve
from ..operators.vector_cells import retrieve_from_cells, write_cells
from ..operators.weighted_chunks import cited_chunks, term_weights, weighted_vectors
from ..sources.outputs import write_vectors


def rebuild_index(documents: DataFrame, key: str, text: str, path: str, size: int = 200, overlap: int = 20, dim: int = 64) -> DataFrame:
    """Chunk, encode and store; questions then read the stored vectors."""
    write_vectors(index_documents(documents, key, text, size, overlap, dim), path)
    return documents.sparkSession.read.parquet(path)


def answer(index: DataFrame, questions: DataFrame, key: str, k: int = 5, dim: int = 64) -> DataFrame:
    """For each (query_id, question) the k nearest chunks, named by document and chunk for checking."""
    asked = questions.select("query_id", encode(F.col("question"), dim).alias("embedding"))
    return retrieve(index, asked, k, [key, "chunk_no"])


PLACE = ["chunk_no", "first_section", "last_section"]


def rebuild_cited_index(
    documents: DataFrame, key: str, text: str, path: str, size: int = 200, overlap: int = 20, dim: int = 64, cells: int | None = None
) -> None:
    """Chunks with their sections, word weights, and the weighted vectors of the chunks in cells, all below `path`."""
    spark = documents.sparkSession
    chunks = cited_chunks(documents, key, text, size, overlap)
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    chunks = spark.read.schema(chunks.schema).parquet(f"{path}/chunks")
    weights = term_weights(chunks)
    weights.write.mode("overwrite").parquet(f"{path}/terms")
    weights = spark.read.schema(weights.schema).parquet(f"{path}/terms")
    vectors = weighted_vectors(chunks, [key, *PLACE], "chunk", weights, chunks.agg(F.count("*")).scalar(), dim)
    vectors.write.mode("overwrite").parquet(f"{path}/encoded")  # read three times for the cells
    write_cells(spark.read.schema(vectors.schema).parquet(f"{path}/encoded"), f"{path}/index", [key, *PLACE], cells=cells)


def cited_answers(documents_index: str, questions: DataFrame, key: str, k: int = 5, dim: int = 64) -> DataFrame:
    """For each (query_id, question) the k nearest chunks of an index by `rebuild_cited_index`, with the sections to check.

    Words weigh as in the index; only cells that can hold one of the k nearest chunks are read.
    """
    spark = questions.sparkSession
    chunks, weights = (spark.read.parquet(f"{documents_index}/{name}") for name in ("chunks", "terms"))
    asked = weighted_vectors(questions, ["query_id"], "question", weights, chunks.agg(F.count("*")).scalar(), dim)
    return retrieve_from_cells(spark, f"{documents_index}/index", asked, k, [key, *PLACE])
