"""Conversation prefix trie against a brute-force version, with every kind of awkward row."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries, trie

TURNS = "conv_id long, turn int, role string, text string"
NO_ID = -(1 << 63)


def brute(conversations: dict) -> list[tuple]:
    """{conv: [(role, text), ...]} to sorted node rows."""
    members: dict[tuple, list] = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    key = lambda c: NO_ID if c is None else c
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves: dict[tuple, int] = {}
    saved: dict[tuple, int] = {}
    for node, own in members.items():
        value = (len(own) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + value
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    out = []
    for node, own in members.items():
        ends = sorted((c for c in own if len(conversations[c]) == len(node)), key=key)
        out.append((min(own, key=key), len(node), min(members[node[:-1]], key=key) if node else None, len(own),
                    children.get(node, 0), leaves[node], saved[node],
                    hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows: list[tuple]) -> dict:
    out: dict = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def rebuilt(rows: list[tuple]) -> dict:
    own = ordered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(("" if c is None else str(c)).encode()) % 6
        head = own.get(c - c % 100, []) if c is not None else []
        out[c] = head[:h] + turns[h:]
    return out


def result(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed: int, n_convs: int, deep: int = 9) -> list[tuple]:
    pick = random.Random(seed)
    rows = []
    for c in range(n_convs):
        for turn in range(pick.randrange(1, deep)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", pick.choice(["a", "bb", "ünï\U0001f642", ""])))
    return rows


@pytest.mark.parametrize("seed, bits", [(1, 22), (2, 7)])  # 7 bits: nearly all estimates are false alarms
def test_random_conversations(spark, seed, bits):
    rows = random_rows(seed, 120)
    got = result(trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(5), bits=bits))
    assert got == brute(ordered(rows))


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "x"), (None, 1, "user", "y"), (5, 0, "user", "x"), (5, 1, None, None), (6, 0, "user", "x"),
            (6, 1, "", ""), (6, 1, "", ""), (7, None, "user", "x"), (7, 0, "user", "b"), (7, 0, "user", "a"), (7, 0, "assistant", "z"),
            (8, 0, "userx", ""), (9, 0, "user", "x" * 300_000), (10, 0, "user", "x" * 300_000), (-3, 0, "user", "x"), (-3, 1, "user", "y")]
    frame = spark.createDataFrame(rows, TURNS)
    want = brute(ordered(rows))
    assert result(trie.prefix_trie(frame)) == want
    clashing = frame.select("*", *[F.lit("mine").alias(c) for c in ("depth", "x1", "conv", "shared", "own", "skip", "part", "at")])
    assert result(trie.prefix_trie(clashing)) == want
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_hot_conversations_span_ranges(spark):
    """Two equal conversations hold two thirds of all rows, and many are copies of one short one."""
    long = [(turn, "user" if turn % 2 else "assistant", f"turn {turn}") for turn in range(1500)]
    rows = [(c, *t) for c in (40, 41) for t in long] + [(42, *t) for t in long[:1200]] + [(42, 5000, "user", "other")]
    rows += [(c, t, "user", "copy") for c in range(100, 700) for t in range(2)]
    rows += [(900, 3, "user", "same")] * 800  # repeated rows are turns
    got = result(trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(8)))
    assert got == brute_long(ordered(rows))


def brute_long(conversations: dict) -> list[tuple]:
    """The same as :func:`brute` with prefix digests, for conversations too long to spell out every prefix."""
    ids: dict[tuple, int] = {}
    paths = {}
    for c, turns in conversations.items():
        at, path = 0, [0]
        for t in turns:
            at = ids.setdefault((at, t), len(ids) + 1)
            path.append(at)
        paths[c] = path
    size = {node: len(t[1]) for (_, t), node in ids.items()}
    parent = {node: up for (up, _), node in ids.items()}
    members: dict[int, list] = {}
    for c, path in paths.items():
        for node in path:
            members.setdefault(node, []).append(c)
    saved = {n: (len(m) - 1) * size.get(n, 0) for n, m in members.items()}
    children = dict.fromkeys(members, 0)
    for n in parent:
        children[parent[n]] += 1
    leaves = {n: int(k == 0) for n, k in children.items()}
    for n in sorted(parent, reverse=True):
        saved[parent[n]] += saved[n]
        leaves[parent[n]] += leaves[n]
    depth = {n: d for p in paths.values() for d, n in enumerate(p)}
    out = []
    for n, own in members.items():
        ends = sorted(c for c in own if paths[c][-1] == n)
        out.append((min(own), depth[n], min(members[parent[n]]) if n else None, len(own), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def write(spark, tmp_path, rows) -> str:
    spark.createDataFrame(rows, TURNS).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_query_rebuilds_conversations(spark, tmp_path):
    rows = [r for r in random_rows(3, 450) if not 200 <= r[0] < 210]  # conversation 200 is absent
    rows += [(None, 0, "user", "a"), (None, 3, "user", "bb"), (300, 50, "user", "tail")]
    got = result(queries.QUERIES["op12_prefix_trie"](spark, write(spark, tmp_path, rows)))
    assert got == brute(rebuilt(rows))


def test_query_on_turnless_and_empty_tables(spark, tmp_path):
    lonely = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 0)  # its base is absent, its turn is left out
    rows = [(lonely, 0, "user", "x")]
    got = result(queries.QUERIES["op12_prefix_trie"](spark, write(spark, tmp_path, rows)))
    assert got == brute(rebuilt(rows)) and len(got) == 1 and got[0][5] == 1
    assert queries.QUERIES["op12_prefix_trie"](spark, write(spark, tmp_path, [])).count() == 0
