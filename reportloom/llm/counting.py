"""Adding up count arrays of tasks without sending all of them to one place."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

PARTS = 64
SALTS = 256


def summed_counts(df: DataFrame, counts: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of `counts`, an integer array of fixed `size`.

    A task adds up its batches and sends the array in PARTS pieces; the pieces of SALTS sets of tasks are
    added before the sums of these. Only one array of the fixed size reaches the driver.
    """
    width = -(-size // PARTS)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = np.zeros(width * PARTS, np.int64), TaskContext.get().partitionId()
        some = False
        for batch in batches:
            total[:size] += counts(batch)
            some = True
        if some:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(PARTS), pa.int32()),
                    pa.array([task % SALTS] * PARTS, pa.int32()),
                    pa.array([piece.tobytes() for piece in np.split(total, PARTS)], pa.binary()),
                ],
                ["part", "salt", "counts"],
            )

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in pdf["counts"])
        return pd.DataFrame({"part": pdf["part"][:1], "salt": pdf["salt"][:1], "counts": [total.tobytes()]})

    schema = "part int, salt int, counts binary"
    sums = df.mapInArrow(per_task, schema).groupBy("part", "salt").applyInPandas(added, schema)
    whole = np.zeros((PARTS, width), np.int64)
    for row in sums.groupBy("part").applyInPandas(added, schema).collect():
        whole[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return whole.ravel()[:size]
