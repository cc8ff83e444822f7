"""Near-duplicate vectors: spherical-cap filters with list-decodable random product codes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from .storage import batches_by_bytes, stored

FILTERS_PER_VECTOR = 16  # filters that a random vector exceeds, on average
LEAST_FILTERS = 24  # best filters of a vector that exceeds fewer
BUCKET = 48  # random vectors per filter, about; the number of filters follows from it
BLOCK = 512  # vectors of one side of a verified cell
PACK_ROWS = 4096  # rows of the small filters that are compared in one go
ROWS = 1024  # vectors that are decoded at a time


def codebook(dim: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation and the code words of both halves, the same wherever they are made."""
    rng = np.random.Generator(np.random.PCG64([dim, size]))
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = [rng.standard_normal((n, size)) for n in (dim - dim // 2, dim // 2)]
    first, second = (h / np.maximum(np.linalg.norm(h, axis=0), 1e-300) / math.sqrt(2) for h in halves)
    return rotation, first, second


def decode(unit: np.ndarray, size: int) -> list[np.ndarray]:
    """Per unit vector, the numbers of all filters that it exceeds, ascending.

    Filter i * size + j is the direction whose halves are code words i and j. For each first half that can still
    reach the threshold with the best second half, the second halves that do reach it are listed.
    """
    n, dim = unit.shape
    if dim < 2:
        return [np.zeros(1, np.int64)] * n
    rotation, first, second = codebook(dim, size)
    turned = unit @ rotation
    a, b = turned[:, : dim - dim // 2] @ first, turned[:, dim - dim // 2 :] @ second
    rate = min(0.25, FILTERS_PER_VECTOR / size**2)
    threshold = NormalDist().inv_cdf(1 - rate) / math.sqrt(dim)
    row, i = np.nonzero(a >= threshold - b.max(1, keepdims=True))
    at, j = np.nonzero(b[row] >= threshold - a[row, i][:, None])
    row, found = row[at], i[at] * size + j
    order = np.lexsort((found, row))
    lists = np.split(found[order], np.searchsorted(row[order], np.arange(1, n)))
    for few in np.flatnonzero([len(x) < LEAST_FILTERS for x in lists]):
        best = [np.argsort(-side[few], kind="stable")[:LEAST_FILTERS] for side in (a, b)]
        sums = (a[few][best[0]][:, None] + b[few][best[1]][None, :]).ravel()
        numbers = (best[0][:, None] * size + best[1][None, :]).ravel()
        lists[few] = np.sort(numbers[np.argsort(-sums, kind="stable")[:LEAST_FILTERS]])
    return lists


def link_vectors(
    vectors: DataFrame, cosine: float, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(id, n_links, component_id, kept): vectors of equal label linked by a cosine of at least `cosine`.

    n_links counts the other vectors linked directly, component_id is the smallest id reachable by links (the own
    id included), kept tells whether that is the own id. Cosines are in double precision; no pair below the limit
    is linked. A pair above it is missed if the two share no filter (see README for the measured recall).

    Equal vectors of a label are one node with a count. Each node goes to all filters that it exceeds; nodes
    of one filter are compared. Filters with more than BLOCK nodes are cut into blocks, and each pair of blocks
    is a cell of its own, so that a group of near copies is spread over many tasks. A pair counts in the smallest
    filter that both nodes share and nowhere else; a cell returns only sums and a spanning forest, never pairs.

    Vectors that are null, zero, empty or hold null or non-finite numbers, and those with a null label, are linked
    with nothing. Vectors of different length are not compared. Null ids are left out; repeated ids are one node
    each time they occur but share one result row, with the sum of the links. An empty table gives an empty one.
    Only the named columns are read.
    """
    batches_by_bytes(vectors)
    # single-precision vectors travel as they are: half the bytes, and cosines are the same, as they are made in doubles
    floats = dict(vectors.dtypes)[vector] == "array<float>"
    rows = vectors.select(
        vectors[id].cast("long").alias("id"),
        vectors[vector].cast("array<float>" if floats else "array<double>").alias("v"),
        vectors[label].alias("label"),
    ).where("id is not null")
    # two hashes stand for a vector where rows are matched with their node
    rows = rows.withColumns({"h1": F.xxhash64(F.lit(1), "v"), "h2": F.xxhash64(F.lit(2), "v")})
    usable = rows.where(F.col("label").isNotNull() & _usable("v"))
    nodes = usable.groupBy("label", "h1", "h2").agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.first("v").alias("v"))
    nodes = stored(nodes.withColumn("dim", F.size("v")), "vector-nodes")
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    size = max(4, math.ceil(math.sqrt(largest * FILTERS_PER_VECTOR / BUCKET)))
    label_type = nodes.schema["label"].dataType.simpleString()

    filtered = nodes.mapInArrow(
        _filter_rows(size), f"label {label_type}, dim int, filter long, node long, copies long, smaller binary, v binary"
    )
    filtered = stored(filtered, "vector-filters")
    # filters of one block are compared many at a time, as most of them are small; the others are few, and cut into cells
    keys = ["label", "dim", "filter"]
    large = filtered.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    large = stored(large.select(*keys, F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks")), "large-filters")
    packs = -(-filtered.count() // PACK_ROWS) or 1
    zero = F.lit(0)
    single = filtered.join(large, keys, "left_anti").select(
        F.lit(None).cast(label_type).alias("own"), "dim", (-1 - F.pmod(F.xxhash64("label", "filter"), F.lit(packs))).alias("pack"),
        "label", "filter", zero.alias("i"), zero.alias("j"), zero.alias("block"), "node", "copies", "smaller", "v",
    )
    placed = filtered.join(large, keys).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = single.unionByName(
        placed.select("*", others.alias("other")).select(
            F.col("label").alias("own"), "dim", F.col("filter").alias("pack"), "label", "filter",
            F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "smaller", "v",
        )
    )
    found = cells.groupBy("own", "dim", "pack", "i", "j").applyInPandas(
        _verify(cosine, "<f4" if floats else "<f8", _number(size)), "node long, links long, near long"
    )
    found = stored(found, "vector-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("near <> node"), "node", "near").withColumnRenamed("node", "member")
    known = nodes.select("label", "h1", "h2", "node", "copies").join(links, "node", "left")
    known = known.join(component, known["node"] == component["member"], "left").select(
        F.col("label").alias("n_label"),
        F.col("h1").alias("n_h1"),
        F.col("h2").alias("n_h2"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    named = rows.select("id", "label", F.when(_usable("v"), F.col("h1")).alias("h1"), "h2")
    same = (named["label"] == known["n_label"]) & (named["h1"] == known["n_h1"]) & (named["h2"] == known["n_h2"])
    out = named.join(known, same, "left").groupBy("id").agg(
        F.coalesce(F.sum("n_links"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.min("component_id"), F.first("id")).alias("component_id"),
    )
    return out.select(F.col("id").alias(id), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def _usable(v: str) -> Column:
    """Whether a vector has a direction: numbers only, all finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(v, lambda x: x != 0)


def _number(size: int) -> str:
    """Type in which filter numbers travel."""
    return "<i4" if size**2 < 1 << 31 else "<i8"


def _units(values: np.ndarray) -> np.ndarray:
    """Rows of length 1, in doubles."""
    unit = values / np.abs(values).max(1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _filter_rows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                names = {name: i for i, name in enumerate(batch.schema.names)}
                dims = batch.column(names["dim"]).to_numpy()
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    taken = batch.take(pa.array(at))
                    values = np.ascontiguousarray(np.array(taken.column(names["v"]).flatten()).reshape(len(at), dim))
                    lists = decode(_units(values.astype(np.float64)), size)
                    many = np.array([len(x) for x in lists])
                    row = pa.array(np.repeat(np.arange(len(at)), many))
                    # in the row of its k-th filter a node carries the k filters before
                    raw, width = [x.astype(_number(size)).tobytes() for x in lists], int(_number(size)[-1])
                    smaller = pa.array([x[: k * width] for x, n in zip(raw, many) for k in range(n)], pa.binary())
                    kept = pa.FixedSizeBinaryArray.from_buffers(
                        pa.binary(values.itemsize * int(dim)), len(at), [None, pa.py_buffer(values.astype(values.dtype.newbyteorder("<")).tobytes())]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            taken.column(names["label"]).take(row),
                            taken.column(names["dim"]).take(row),
                            pa.array(np.concatenate(lists)),
                            taken.column(names["node"]).take(row),
                            taken.column(names["copies"]).take(row),
                            smaller,
                            kept.cast(pa.binary()).take(row),
                        ],
                        ["label", "dim", "filter", "node", "copies", "smaller", "v"],
                    )

    return rows


def _verify(cosine: float, kind: str, number: str):
    def verify(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """The cells of a group: one for each label and filter, of the blocks i and j."""
        i, j = key[3], key[4]
        label = pd.factorize(pdf["label"])[0]
        order = np.lexsort((pdf["node"], pdf["filter"], label))
        column = {name: pdf[name].to_numpy()[order] for name in ("filter", "block", "node", "copies", "smaller", "v")}
        v = _units(np.frombuffer(b"".join(column["v"]), kind).reshape(len(order), -1).astype(np.float64))
        change = (np.diff(column["filter"]) != 0) | (np.diff(label[order]) != 0)
        bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(order)]])
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            block = column["block"][a:b]
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if len(left) and len(right):
                out.append(_cell(v[a:b], column["node"][a:b], column["copies"][a:b], column["smaller"][a:b], left, right, i == j))
        return pd.DataFrame(dict(zip(("node", "links", "near"), map(np.concatenate, zip(*out)) if out else 3 * [np.zeros(0, np.int64)])))

    def _cell(v: np.ndarray, node: np.ndarray, copies: np.ndarray, smaller: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool):
        """(node, links, near) of the nodes that are linked in one cell; near is the smallest node of their part of it."""
        near = v[left] @ v[right].T >= cosine
        if same:
            np.fill_diagonal(near, False)
        if not near.any():
            return node[:0], copies[:0], node[:0]
        # a pair that also shares a smaller filter counts there
        _, code = np.unique(np.frombuffer(b"".join(smaller), number), return_inverse=True)
        held = np.zeros((len(node), int(code.max(initial=-1)) + 1), np.float32)
        held[np.repeat(np.arange(len(node)), [len(x) // int(number[-1]) for x in smaller]), code] = 1
        near &= held[left] @ held[right].T == 0

        links = np.zeros(len(node), np.int64)
        links[left] += near @ copies[right]
        if not same:
            links[right] += near.T @ copies[left]
        # smallest member of each connected part of the cell, by passing the smallest number on
        least = np.arange(len(node))
        while True:
            after = least.copy()
            after[left] = np.minimum(after[left], np.where(near, least[right][None, :], len(node)).min(1))
            after[right] = np.minimum(after[right], np.where(near, after[left][:, None], len(node)).min(0))
            after = np.minimum(after, after[after])
            if (after == least).all():
                break
            least = after
        some = links > 0
        return node[some], links[some], node[least[some]]

    return verify
