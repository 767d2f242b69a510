"""The trie of conversations against a dictionary of all their beginnings."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from lexispan.llm import prefix_trie, queries
from lexispan.llm.parentheses import Parentheses
from lexispan.llm.workers import known_to_workers

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role: str, text: str) -> str:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30]


def expected(rows: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), digest(role, text), role, text))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in members if len(m) == len(node) + 1 and m[:-1] == node]
        leaves = [m for m in below if not any(len(o) == len(m) + 1 and o[:-1] == m for o in members)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations() -> list[tuple]:
    random.seed(9)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(305, 320), -7, -100, -105]:
        for t in range(random.randrange(1, 7)):
            rows.append((c, t, random.choice(["user", "bot"]), random.choice(["hi", "é🙂", "what is it", "", "yes"])))
    rows += [(500 + i, t, "user", "same") for i in range(60) for t in range(3)]  # copies
    rows += [(700, None, "user", "first"), (700, 2, None, None), (700, 1, "a", "b"), (700, 1, "ab", ""), (700, 1, "ab", ""), (None, 0, "user", "lost")]
    rows += [(800, t, "user", f"deep {t}") for t in range(300)] + [(801, t, "user", f"deep {t}") for t in range(290)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [prefix_trie.SHARD_TURNS, 120, 15])
def test_nodes_against_all_beginnings(spark, shard_turns):
    known_to_workers(spark)
    rows = conversations()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = prefix_trie.prefix_trie(prefix_trie.sharing_first_turns(prefix_trie.turn_lists(table)), shard_turns)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_pieces_of_ends(spark, monkeypatch):
    known_to_workers(spark)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 4)
    members = spark.createDataFrame([(i % 2, 0, i) for i in range(50)] + [(7, 1, 3)], "p1 long, p2 long, conv_id long")
    found = {(r.p1, r.p2): r.ends for r in prefix_trie._end_digests(members).collect()}
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found == {(0, 0): sha(range(0, 50, 2)), (1, 0): sha(range(1, 50, 2)), (7, 1): sha([3])}


def test_empty_and_turnless(spark):
    known_to_workers(spark)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.turn_lists(empty)).count() == 0
    # Conversation 3 has fewer turns than it takes over, and there is no conversation 0.
    rows = [(c, 0, "user", "x") for c in range(1, 9)]
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, n long, path string")
    found = prefix_trie.prefix_trie(prefix_trie.sharing_first_turns(prefix_trie.turn_lists(table)))
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_closing_parentheses():
    random.seed(10)
    for size in (1, 2, 30, 63, 64, 65, 500, 5000):
        depth, bits, left = 0, [], size
        while left or depth:
            if left and (not bits or depth > 1 and random.random() < 0.52 or depth == 1):
                bits.append(True)
                left, depth = left - 1, depth + 1
            elif depth:
                bits.append(False)
                depth -= 1
        tree = Parentheses(np.array(bits))
        stack, closes = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                closes[stack.pop()] = i
        assert tree.close(tree.places).tolist() == [closes[p] for p in tree.places.tolist()]


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    result = connection.execute(prefix_trie.oracle()).fetchall()
    found = queries.LLM_QUERIES["op12_prefix_trie"](spark, folder)
    assert found.columns == COLUMNS and sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, result))
