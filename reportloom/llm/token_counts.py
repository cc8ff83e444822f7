"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import batches_by_bytes
from .tokens import encoder


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `vocabulary` is the path of a tokenizers file, the same on every machine. Only lengths leave the Python
    workers. A worker takes its Arrow batches apart into blocks of about equal bytes and cuts texts at safe
    boundaries (see `tokens`), so that neither many short texts nor one long text decides its memory.

    A null text counts as empty (0 bytes, 0 tokens, not over the limit); null ids and repeated rows are kept
    as they are; an empty table gives an empty one. Only `id` and `text` are read, so other columns of any
    name do not matter.
    """
    batches_by_bytes(docs)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            n_tokens = np.zeros(len(texts), np.int64)
            for first, end, _, offsets in encode.blocks(texts):
                n_tokens[first:end] = np.diff(offsets)
            n_bytes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(n_tokens), pa.array(n_tokens > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.select(id).schema[0].dataType.simpleString()
    return (
        docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"))
        .mapInArrow(lengths, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
        .withColumnRenamed("id", id)
    )
