"""The prefix trie of conversations against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reportloom.llm import prefix_trie as module
from reportloom.llm.prefix_trie import Skeleton, _common, conversation_paths, prefix_trie, shared_history_paths

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)


def ordered(rows):
    """Turns (role, text) per conversation in the operator's order."""
    def place(row):
        role, text = row[2] or "", row[3] or ""
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        return (row[1] is not None, row[1] or 0, role, digest)

    found = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=place):
        found[row[0]].append((row[2] or "", row[3] or ""))
    return found


def rebuilt(conversations):
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conversations.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain_trie(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def leaves(path):
        return sum(map(leaves, children[path])) if children[path] else 1

    def saved(path):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        return own + sum(map(saved, children[path]))

    rows = []
    for path, ids in members.items():
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        rows.append((min(ids), len(path), parent, len(ids), len(children[path]), leaves(path), saved(path), digest))
    return sorted(rows, key=str)


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def chat_rows(seed=1, n=120):
    rng = random.Random(seed)
    first = [("system", "Be kind. é"), ("user", "Hello"), ("assistant", "Hi"), ("user", "")]
    rows = []
    for c in range(n):
        if c % 7 == 6:
            continue  # families without their first conversation, too
        # a third of all are one conversation, many share beginnings, some have few turns
        turns = first[: rng.randint(1, 4)] if c % 3 else first * 3
        turns = turns + [(rng.choice(["user", "assistant"]), rng.choice(["a", "b", "ç", "a b"])) for _ in range(rng.randint(0, 6) if c % 3 else 0)]
        rows += [(c, t, role, text) for t, (role, text) in enumerate(turns)]
    rows += [(200, None, "user", "null turn"), (200, 1, None, None), (200, 1, "user", "tie"), (200, 1, "user", "tie"), (None, 0, "user", "lost")]
    return rows + [(201, 5, "user", "x " * 40_000), (-3, 0, "user", "minus"), (202, 0, "", "")]


@pytest.mark.parametrize("shard_turns", [module.SHARD_TURNS, 100, 12])
def test_trie_against_a_plain_one(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(module, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(module, "CHUNK_IDS", 3)
    rows = chat_rows()
    turns = table(spark, rows).withColumns({c: F.lit("x") for c in ("path", "sizes", "shard", "depth", "first", "rows", "n_convs")})
    assert result(prefix_trie(conversation_paths(turns))) == plain_trie(ordered(rows))
    own = {c: t for c, t in ordered(rows).items() if c >= 0}
    assert result(prefix_trie(shared_history_paths(turns.where("conv_id >= 0")))) == plain_trie(rebuilt(own))


def test_one_shared_conversation_is_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(module, "SHARD_TURNS", 60)
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)]
    paths = conversation_paths(table(spark, rows))
    skeleton = Skeleton(module._splitters(paths))
    found = [skeleton.shard(bytes(r["path"]), r["conv_id"]) for r in paths.collect()]
    assert len(set(found)) > 10 and max(map(found.count, set(found))) < 100
    assert result(prefix_trie(paths)) == plain_trie(ordered(rows))


def test_trie_of_empty_and_turnless_tables(spark):
    assert prefix_trie(conversation_paths(table(spark, []))).count() == 0
    assert prefix_trie(shared_history_paths(table(spark, []))).count() == 0
    rows = [(c, 0, "user", "only") for c in (1, 2, 3, 4)]  # no conversation 0: those with h > 0 lose their only turn
    want = plain_trie(rebuilt(ordered(rows)))
    assert any(depth == 0 and n == 4 for _, depth, _, n, *_ in want)
    assert result(prefix_trie(shared_history_paths(table(spark, rows)))) == want


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(module, "SHARD_TURNS", 500)
    rows = [(c, t, "user", "same" if t < 1500 else f"{c}") for c in range(6) for t in range(1600)]
    got = result(prefix_trie(conversation_paths(table(spark, rows))))
    assert len(got) == 1501 + 6 * 100
    assert {(r[1], r[3]) for r in got if r[1] <= 1500} == {(d, 6) for d in range(1501)}
    assert [r[5] for r in got if r[1] == 0] == [6] and max(r[6] for r in got) == 1500 * 5 * 4


def test_common_turns():
    def path(*turns):
        return b"".join(bytes([t]) * 16 for t in turns)

    assert _common(b"", path(1)) == 0 and _common(path(1, 2), path(1, 2, 3)) == 2 and _common(path(1, 2, 3), path(1, 4, 3)) == 1
    assert _common(path(5), path(6)) == 0 and _common(path(*range(40)), path(*range(39), 77)) == 39
