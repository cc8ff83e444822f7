"""Prefix trie of conversations: shared beginnings, their sizes, and what keeping them once would save."""

from __future__ import annotations

import bisect
import hashlib
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import batches_by_bytes, stored

STEP = 16  # bytes of a path for each turn
SHARD_TURNS = 1 << 18  # turns a shard should hold
MOST_SHARDS = 1 << 14  # bound of the splitters that travel to all tasks; beyond it shards grow
SAMPLES = 8  # conversations looked at for each shard when splitters are chosen
CHUNK_IDS = 8192  # conversation ids in one piece of a node's list

_NODE = "n_convs long, n_children long, n_leaves long, saved_tokens long"
_SCHEMA = (
    f"kind int, conv_id long, depth long, {_NODE}, ends_sha256 string, parent_conv_id long, first int, parent_first int, "
    "shard int, chunk int, ids binary"
)
_FINISHED, _PARTIAL, _ENDS = 0, 1, 2
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turn_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, step): a turn's place in the order, the MD5 of its role and text, and the bytes of its text."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        F.struct(
            turns["turn"].alias("turn"), role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")
        ).alias("step"),
    )
    return rows.where("conv_id is not null")


def _path(steps: Column) -> tuple[Column, Column]:
    joined = F.array_join(F.transform(steps, lambda s: s["digest"]), "")
    return F.unhex(joined).alias("path"), F.transform(steps, lambda s: s["size"]).alias("sizes")


def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) per conversation: its turns in order, 16 bytes each, and the bytes of their texts.

    `turns` has conv_id, turn, role, text. Turns are ordered by turn (null first), then role and the MD5 of both, so that
    repeated rows stay separate turns. Null roles and texts count as empty; rows without a conv_id are left out. Texts are
    hashed where they are read and do not move; equal paths mean equal conversations but for collisions of 128 bits.
    """
    rows = _turn_rows(turns).groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    return rows.select("conv_id", *_path(F.col("steps")))


def shared_history_paths(turns: DataFrame, family: int = 5, longest: int = 9) -> DataFrame:
    """`conversation_paths` of conversations that begin with turns of their family's first conversation.

    Conversation c takes the first h turns of conversation c - c % family (all if it has fewer, none if it does not exist),
    h being the CRC-32 of the decimal c modulo `longest`, and then its own turns behind its first h. One shuffle brings a
    family together: at most `family` conversations.
    """
    head = F.col("conv_id") - F.col("conv_id") % family
    families = _turn_rows(turns).groupBy(head.alias("head")).agg(
        F.sort_array(F.collect_list(F.struct("conv_id", "step"))).alias("rows")
    )
    members = families.select("head", "rows", F.explode(F.array_distinct("rows.conv_id")).alias("conv_id"))

    def of(conversation: Column) -> Column:
        return F.transform(F.filter("rows", lambda r: r["conv_id"] == conversation), lambda r: r["step"])

    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    parts = members.select("conv_id", of(F.col("head")).alias("base"), of(F.col("conv_id")).alias("own"), borrowed.alias("h"))
    steps = F.concat(F.slice("base", F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own")))
    return parts.withColumn("steps", steps).select("conv_id", *_path(F.col("steps")))


def _common(a: bytes, b: bytes) -> int:
    """Number of leading turns that two paths share."""
    end = min(len(a), len(b))
    if a[:end] == b[:end]:
        return end // STEP
    low, high = 0, end // STEP  # the first `low` turns agree, the first `high` do not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * STEP : middle * STEP] == b[low * STEP : middle * STEP]:
            low = middle
        else:
            high = middle
    return low


class Skeleton:
    """The trie of the splitters' paths. All of its nodes, and no others, can have members in more than one shard.

    A node is named by the first splitter that has it on its path, and by its depth.
    """

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.shared = [-1] + [_common(a, b) for (a, _), (b, _) in itertools.pairwise(splitters)]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect.bisect_right(self.splitters, (path, conv_id))

    def first(self, splitter: int, depth: int) -> int:
        while self.shared[splitter] >= depth:
            splitter -= 1
        return splitter


def _splitters(paths: DataFrame) -> list[tuple[bytes, int]]:
    """Rows of the table that cut its order into shards of about equal numbers of turns; a bounded sample proposes them."""
    n, turns = paths.agg(F.count("*"), F.sum(F.size("sizes"))).first()
    shards = min(MOST_SHARDS, -(-(turns or 0) // SHARD_TURNS))
    if shards < 2:
        return []
    some = paths.sample(min(1.0, SAMPLES * shards / n), seed=1).select("path", "conv_id").collect()
    some = sorted((bytes(r["path"]), r["conv_id"]) for r in some)
    upto = list(itertools.accumulate(len(path) // STEP + 1 for path, _ in some))
    wanted = (bisect.bisect_left(upto, upto[-1] * k / shards) for k in range(1, shards)) if some else ()
    return [some[i] for i in sorted(set(wanted))]


class _Open(NamedTuple):
    """What is fixed about a node on the path of the current conversation."""

    size: int  # bytes of its last text
    first: int  # its name on the skeleton, -1 for a node that this shard finishes
    stays_open: bool  # a later shard has members too


class _Shard:
    """One pass over the sorted conversations of a shard, with the nodes of the current path on a stack.

    Every sum of a node is a plain sum over shards: what counts once per node (the node as a child, as a leaf, and its
    text kept once) is counted in the last shard that has members of it, and there the last rows show whether it has
    children.
    """

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard, self.rows = skeleton, shard, []
        n = len(skeleton.splitters)
        self.left = skeleton.splitters[shard - 1][0] if 0 < shard <= n else None
        self.right = skeleton.splitters[shard][0] if shard < n else None
        self.path: bytes = b""
        self.nodes: list[_Open] = []
        self.sums: list[list[int | None]] = []  # conversations, smallest one, children, leaves, saved, children seen here
        self.waiting: list[list[tuple]] = []  # finished children, until the node's smallest member is known
        self.ends: list = []

    def add(self, path: bytes, sizes: list[int], conv_id: int) -> None:
        shared = _common(self.path, path) if self.nodes else -1
        while len(self.nodes) > shared + 1:
            self._pop()
        depth = len(path) // STEP
        if shared < depth:
            left = -1 if self.left is None else _common(path, self.left)
            right = -1 if self.right is None else _common(path, self.right)
            for d in range(shared + 1, depth + 1):
                first = -1
                if d <= left:
                    first = self.skeleton.first(self.shard - 1, d)
                elif d <= right:
                    first = self.skeleton.first(self.shard, d)
                self.nodes.append(_Open(sizes[d - 1] if d else 0, first, d <= right))
                self.sums.append([0, None, 0, 0, 0, 0])
                self.waiting.append([])
                self.ends.append(None)
                if d:
                    self.sums[d - 1][5] += 1
        self.path = path
        sums = self.sums[depth]
        sums[0] += 1
        sums[1] = conv_id if sums[1] is None else min(sums[1], conv_id)
        if self.nodes[depth].first < 0:
            if self.ends[depth] is None:
                self.ends[depth] = hashlib.sha256(b"%d" % conv_id)
            else:
                self.ends[depth].update(b",%d" % conv_id)
        else:
            held = self.ends[depth] = self.ends[depth] or [0, []]
            held[1].append(conv_id)
            if len(held[1]) >= CHUNK_IDS:
                self._chunk(depth, held)

    def close(self) -> None:
        while self.nodes:
            self._pop()

    def _chunk(self, depth: int, held: list) -> None:
        ids = ",".join(map(str, held[1])).encode()
        self.rows.append((_ENDS, None, depth, *[None] * 6, self.nodes[depth].first, None, self.shard, held[0], ids))
        held[0], held[1] = held[0] + 1, []

    def _pop(self) -> None:
        depth = len(self.nodes) - 1
        node, (n, least, children, leaves, saved, seen), waiting, ends = (
            x.pop() for x in (self.nodes, self.sums, self.waiting, self.ends)
        )
        closes = not node.stays_open
        leaves += closes and not seen
        saved += (n - closes) * node.size
        parent = self.nodes[-1] if depth else None
        if depth:
            above = self.sums[-1]
            above[0] += n
            above[1] = least if above[1] is None else min(above[1], least)
            above[2] += closes
            above[3] += leaves
            above[4] += saved
        facts = (least, depth, n, children, leaves, saved)
        parent_first = parent.first if parent and parent.first >= 0 else None
        if node.first >= 0:
            if ends and ends[1]:
                self.nodes.append(node)
                self._chunk(depth, ends)
                self.nodes.pop()
            self.rows.append((_PARTIAL, *facts, None, None, node.first, parent_first, None, None, None))
            return
        self.rows += [(_FINISHED, *child, least, None, None, None, None, None) for child in waiting]
        row = (*facts, ends.hexdigest() if ends else _NO_ENDS)
        if parent and parent_first is None:
            self.waiting[-1].append(row)
        else:  # the root, or a child of a skeleton node, whose smallest member comes later
            self.rows.append((_FINISHED, *row, None, None, parent_first, None, None, None))


def _finish_shards(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _SCHEMA.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in _SCHEMA.split(", ")])

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], names
            )

        current: _Shard | None = None
        for batch in batches:
            for shard, path, sizes, conv_id in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if current is None or current.shard != shard:
                    if current is not None:
                        current.close()
                        yield out(current.rows)
                    current = _Shard(skeleton, shard)
                current.add(path, sizes, conv_id)
            if current is not None and len(current.rows) > 10_000:
                yield out(current.rows)
                current.rows = []
        if current is not None:
            current.close()
            yield out(current.rows)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids; the pieces come sorted by node, shard and number."""
    names = ["first", "depth", "ends_sha256"]
    key, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for first, depth, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (first, depth) != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (first, depth), hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.int64(), pa.string()))], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([digest.hexdigest()])], names)


def prefix_trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations: `paths` has conv_id, path, sizes (see `conversation_paths`).

    Every distinct sequence of first d turns is a node of depth d, the root (d = 0) included; conversations that begin
    with it are its members. Per node: conv_id (its smallest member, which with the depth names it), depth, parent_conv_id
    (null for the root), n_convs, n_children, n_leaves (childless nodes in its subtree), saved_tokens (summed over the
    subtree: members less one, times the UTF-8 bytes of the last text), ends_sha256 (of the decimal ids of members that end
    there, ascending, comma-joined).

    Conversations are sorted by (path, conv_id) in shards cut at splitter rows, so a conversation that very many share is
    spread over shards too. The trie of the splitters' paths goes to all tasks: only its nodes, the skeleton, can reach
    over a border. A shard finishes all others in one pass and sends partial sums for its skeleton nodes (at most its two
    splitters' turns), which are added up per node. A shard's memory holds one path and the finished children of nodes
    that are still open. Splitters are at most MOST_SHARDS rows of 16 bytes a turn; `sizes` of one conversation is one row.

    An empty table gives an empty one. Repeated conv_ids count as separate members. Other columns are ignored.
    """
    batches_by_bytes(paths)
    paths = stored(paths.select("conv_id", "path", "sizes"), "paths")
    skeleton = Skeleton(_splitters(paths))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = [skeleton.shard(path, conv_id) for path, conv_id in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int32()), batch.column(1), batch.column(0), batch.column(2)], ["shard", "path", "sizes", "conv_id"]
            )

    placed = paths.select("sizes", "path", "conv_id").mapInArrow(place, "shard int, path binary, sizes array<long>, conv_id long")
    shards = placed.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    rows = stored(shards.mapInArrow(_finish_shards(skeleton), _SCHEMA), "trie-shards")

    pieces = rows.where(F.col("kind") == _ENDS).repartition("first", "depth").sortWithinPartitions("first", "depth", "shard", "chunk")
    ends = pieces.select("first", "depth", "ids").mapInArrow(_digests, "first int, depth long, ends_sha256 string")
    spine = rows.where(F.col("kind") == _PARTIAL).groupBy("first", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("parent_first").alias("parent_first"),
    )
    spine = stored(spine.join(ends, ["first", "depth"], "left").fillna(_NO_ENDS, ["ends_sha256"]), "trie-skeleton")
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    finished = rows.where(F.col("kind") == _FINISHED)
    own = spine.select(*columns, F.lit(None).cast("long").alias("parent_conv_id"), "parent_first")
    below = finished.select(*columns, "parent_conv_id", "parent_first").unionByName(own)
    parents = spine.select(F.col("first").alias("parent_first"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))
    joined = below.join(parents, ["parent_first", "depth"], "left")
    return joined.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), *columns[2:]
    )
