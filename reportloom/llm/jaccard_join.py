"""Exact n-gram Jaccard join of documents through a token-group matrix."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import fresh_dir
from .counting import summed_counts
from .graph import connected_components
from .hashing import mixed, shingle_sets
from .storage import batches_by_bytes, stored

FAMILY_KEYS = 3  # min-hashes that propose the documents of one family
GROUP_DOCS = 64  # documents of one group of the matrix, at most about
SIZE_BAND = 1.04  # sizes of the sets of one group differ by this factor at most
EXTRA_TOKENS = 2  # tokens beyond the shortest prefix
SKETCH_BITS = 20  # counters of the frequency sketch, as a power of two
_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, FAMILY_KEYS, dtype=np.uint64)


def jaccard_classes(docs: DataFrame, words: int, percent: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): documents linked by 100 * intersection >= `percent` * union.

    A document's set holds the distinct runs of `words` words (ASCII white space between words, A-Z
    lower-cased); a shorter text is one run; a text without words is empty and linked with nothing.
    component_id is the smallest id reachable by links, the own id included. The join is exact but for
    collisions of 64-bit hashes.

    1. Equal sets are one class; only its smallest id, the representative, goes on. The representatives'
       texts are bucketed by id once, and no later step shuffles all texts again.
    2. Representatives that share a min-hash are compared with the one of them whose tokens are the most common
       on average, which for near copies is close to their original. The components of these links are the
       families. Pairs inside a family need no comparison, however large it is.
    3. The token-group matrix: documents of a family, or else with the same leader, are cut into groups of
       similar size and of GROUP_DOCS documents at most, about. For each token the matrix names the groups in
       which the token is among the rarest of some document. A set of n tokens shares need(n) = ceil(n *
       percent / 100) tokens with any partner; its n - need(n) + 1 + e rarest tokens are its prefix. Two sets
       with c common prefix tokens overlap in c + max(n - prefix, m - prefix) tokens at most. With the
       entries that a query shares with a group for c, this bounds its overlap with every document of the group;
       a group whose bound is too small holds no partner and is not opened.
    4. Two documents of different families are compared in full if each opens the group of the other and their
       sizes match.
    "Rarest" goes by a sketch of token counts over all documents. The sketch has a fixed size; it only decides
    the order, so that coarse counts cost time and never results.

    Null and empty texts have an empty set. Rows with a null id are left out. Repeated ids are one document, that
    of the longest text (of equally long ones, by a hash). An empty table gives an empty one. Only `id` and
    `text` are read.
    """
    batches_by_bytes(docs)
    rows = docs.select(docs[id].cast("long").alias("id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    rows = rows.where("id is not null")
    order = _frequency_sketch(rows, words)
    signed = rows.select("id", "text", F.length("text").alias("length"), F.xxhash64("text").alias("mark")).mapInArrow(
        _signatures(words, order), "id long, length int, mark long, n long, fp1 long, fp2 long, common long, keys array<long>"
    )
    signed = stored(signed, "signatures")
    one = signed.groupBy("id").agg(F.max(F.struct("length", "mark", "n", "fp1", "fp2", "common", "keys")).alias("s"))
    one = one.select("id", "s.*").drop("length", "mark")
    classes = one.where("n > 0").groupBy("n", "fp1", "fp2").agg(
        F.min("id").alias("rep"), F.first("common").alias("common"), F.first("keys").alias("keys")
    )
    classes = stored(classes, "classes")
    texts, name = _bucketed_texts(rows, classes, signed)
    try:
        links = stored(_links(texts, classes, words, percent, order), "links")
    finally:
        texts.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    component = connected_components(links, "a", "b")
    named = classes.join(component, classes["rep"] == component["node"], "left").select(
        "n", "fp1", "fp2", F.coalesce("component", "rep").alias("component_id")
    )
    return one.join(named, ["n", "fp1", "fp2"], "left").select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


def _links(texts: DataFrame, classes: DataFrame, words: int, percent: int, order: Broadcast) -> DataFrame:
    """(a, b): links between representatives, as many as their components need; see `jaccard_classes`."""
    keyed = classes.select("rep", "common", F.posexplode("keys").alias("i", "key"))
    leaders = keyed.groupBy("i", "key").agg(F.max(F.struct("common", -F.col("rep")))["col2"].alias("leader"), F.count("*").alias("size"))
    leaders = leaders.where("size > 1").select("i", "key", (-F.col("leader")).alias("leader"))
    pairs = keyed.join(leaders, ["i", "key"]).where("rep <> leader")
    pairs = pairs.select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = stored(pairs, "leader-pairs")
    close = stored(_verified(texts, pairs, words, percent), "leader-links")

    reps = _grouped(classes, connected_components(close, "a", "b"), pairs)
    matrix = _matrix_rows(texts, reps, words, percent, order)
    pairs = stored(_candidates(matrix, percent), "candidates")
    return close.unionByName(_verified(texts, pairs, words, percent))


def _signatures(words: int, order: Broadcast):
    """Size, two sums of hashes that name the set, how common its tokens are, and min-hashes."""

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.zeros((4, batch.num_rows), np.int64)
            keys: list[list[int]] = []
            counts, mask = order.value, np.uint64(len(order.value) - 1)
            for row, found in enumerate(shingle_sets(batch.column(1), words)):
                if len(found):
                    common = int(1000 * counts[(found & mask).astype(np.int64)].mean())
                    sums = found.sum().view(np.int64), mixed(found ^ _SEEDS[0]).sum().view(np.int64)
                    numbers[:, row] = len(found), *sums, common
                    keys.append([int(mixed(found + seed).min().view(np.int64)) for seed in _SEEDS])
                else:
                    keys.append([])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in (0, 2, 3)), *map(pa.array, numbers), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "length", "mark", "n", "fp1", "fp2", "common", "keys"],
            )

    return signatures


def _bucketed_texts(rows: DataFrame, classes: DataFrame, signed: DataFrame) -> tuple[DataFrame, str]:
    """(id, text) of the representatives, bucketed and sorted by id in shared storage, and the table's name.

    Buckets need a table of the catalog; the caller drops it when the links are stored. Its files lie below the folder of
    intermediate tables.
    """
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    largest = rows if signed.groupBy("id").count().where("count > 1").isEmpty() else _largest_texts(rows)
    reps = largest.join(classes.select(F.col("rep").alias("id"), "n"), "id").select("id", "n", "text")
    writer = reps.repartition(buckets, "id").write.bucketBy(buckets, "id").sortBy("id")
    writer.option("path", fresh_dir(spark, "texts")).saveAsTable(name)
    return spark.table(name), name


def _largest_texts(rows: DataFrame) -> DataFrame:
    """One text per id, where ids repeat: the longest, of equally long ones by a hash."""
    return rows.groupBy("id").agg(F.max_by("text", F.struct(F.length("text"), F.xxhash64("text"))).alias("text"))


def _verified(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Only the texts of paired documents move."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    needed = stored(texts.join(ids, "id").select("id", "text"), "paired-texts")
    full = pairs.join(needed.toDF("a", "a_text"), "a").join(needed.toDF("b", "b_text"), "b")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(shingle_sets(batch.column(2), words), shingle_sets(batch.column(3), words)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common) > 0)
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "a_text", "b_text").mapInArrow(similar, "a long, b long")


def _grouped(classes: DataFrame, families: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rep, n, family, grp): the verified family of each representative, and its group in the matrix."""
    follows = pairs.groupBy(F.col("b").alias("follower")).agg(F.min("a").alias("leader"))
    reps = classes.join(families, classes["rep"] == families["node"], "left").join(follows, F.col("rep") == F.col("follower"), "left")
    reps = reps.select(
        "rep",
        "n",
        F.coalesce("component", "rep").alias("family"),
        F.struct(F.col("component").isNotNull().alias("verified"), F.coalesce("component", "leader", "rep").alias("of")).alias("cluster"),
        F.floor(F.log(F.col("n")) / F.log(F.lit(SIZE_BAND))).alias("band"),
    )
    # both stored, so that Spark can split a cluster of very many documents in the join
    reps = stored(reps, "clusters")
    sizes = stored(reps.groupBy("cluster", "band").agg(F.count("*").alias("members")), "cluster-sizes")
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("members") / F.lit(GROUP_DOCS)))
    grp = F.xxhash64("cluster", "band", part)
    return stored(reps.join(sizes, ["cluster", "band"]).select("rep", "n", "family", grp.alias("grp")), "groups")


def _matrix_rows(texts: DataFrame, reps: DataFrame, words: int, percent: int, order: Broadcast) -> DataFrame:
    """(token, id, n, family, grp): the prefix tokens of each document that some other family has in a prefix too."""
    placed = texts.join(reps.select(F.col("rep").alias("id"), "family", "grp"), "id").select("id", "n", "family", "grp", "text")
    rare = placed.mapInArrow(_rare_tokens(words, percent, order), "token long, id long, n int, family long, grp long").repartition("token")
    shared = rare.groupBy("token").agg(F.min("family").alias("low"), F.max("family").alias("high"))
    return stored(rare.join(shared.where("low <> high").select("token"), "token"), "token-groups")


def _candidates(matrix: DataFrame, percent: int) -> DataFrame:
    """(a, b): documents of matching size that open each other's groups."""
    groups = matrix.groupBy("token", F.col("grp").alias("g")).agg(F.min("family").alias("low"), F.max("family").alias("high"))
    # an entry counts if a document of another family has made it
    hits = matrix.join(groups, "token").where("family <> low or family <> high")
    shared = hits.groupBy("id", "n", "family", "grp", "g").agg(F.count("*").alias("common"))
    # stored, so that the join below has plain sides and Spark can split a group with very many queries
    ranges = stored(matrix.groupBy(F.col("grp").alias("g")).agg(F.min("n").alias("least"), F.max("n").alias("most")), "group-sizes")

    def need(n: str) -> str:
        return f"(({n} * {percent} + 99) div 100)"

    def rest(n: str) -> str:  # tokens behind the prefix
        return f"greatest(0, {need(n)} - 1 - {EXTRA_TOKENS})"

    def overlap(n: str, m: str) -> str:  # that similar sets of these sizes have at least
        return f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"

    bound = f"{overlap('n', f'greatest(least, {need("n")})')} - greatest({rest('n')}, {rest('most')})"
    opened = shared.join(ranges, "g").where(f"common >= {bound}").select("id", "n", "family", "grp", "g")
    opened = stored(opened, "opened-groups")
    others = opened.toDF("other", "m", "o_family", "g", "grp")
    return (
        opened.join(others, ["grp", "g"])
        .where((F.col("id") < F.col("other")) & (F.col("family") != F.col("o_family")))
        .where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        .select(F.col("id").alias("a"), F.col("other").alias("b"))
    )


def _need(n: int, percent: int) -> int:
    """The least overlap of a set of n tokens with any partner."""
    return -(-n * percent // 100)


def _rare_tokens(words: int, percent: int, order: Broadcast):
    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order.value
        mask = np.uint64(len(counts) - 1)
        for batch in batches:
            picked, sizes = [], []
            for tokens in shingle_sets(batch.column(4), words):
                n = len(tokens)
                need = _need(n, percent)
                extra = min(EXTRA_TOKENS, need - 1)
                size = min(n, n - need + 1 + extra)
                # hash order breaks ties of the count, the same way for every document
                ranked = np.argsort(counts[(tokens & mask).astype(np.int64)], kind="stable")
                picked.append(tokens[ranked[:size]])
                sizes.append(size)
            if not sizes:
                continue
            row = np.repeat(np.arange(batch.num_rows), sizes)
            cut = max(1, 2_000_000 * len(sizes) // max(1, len(row)))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            tokens = np.concatenate(picked).view(np.int64)
            for first in range(0, len(sizes), cut):
                a, b = ends[first], ends[min(first + cut, len(sizes))]
                take = pa.array(row[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tokens[a:b]),
                        batch.column(0).take(take),
                        batch.column(1).take(take).cast(pa.int32()),
                        batch.column(2).take(take),
                        batch.column(3).take(take),
                    ],
                    ["token", "id", "n", "family", "grp"],
                )

    return rare


def _frequency_sketch(rows: DataFrame, words: int) -> Broadcast:
    """Counts of all documents' tokens by their low SKETCH_BITS bits, as a broadcast array of fixed size."""
    size, mask = 1 << SKETCH_BITS, np.uint64((1 << SKETCH_BITS) - 1)

    def counts(batch: pa.RecordBatch) -> np.ndarray:
        total, held, n = np.zeros(size, np.int64), [], 0
        for found in [*shingle_sets(batch.column(0), words), None]:
            if found is not None:
                held.append(found)
                n += len(found)
            if held and (found is None or n > size):
                total += np.bincount((np.concatenate(held) & mask).astype(np.int64), minlength=size)
                held, n = [], 0
        return total

    whole = summed_counts(rows.select("text"), counts, size)
    ranks = np.minimum(np.ceil(16 * np.log2(1 + whole)), 1023).astype(np.uint16)
    return rows.sparkSession.sparkContext.broadcast(ranks)
