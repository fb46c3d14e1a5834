"""The prefix trie against a dictionary of prefixes; parentheses against a stack."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from llm_tables import LONG, write

from tidemark.llm import prefix_trie
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.prefix_trie import Parentheses
from tidemark.llm.queries import op12_prefix_trie


def by_stack(bits):
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    return [close[i] for i, b in enumerate(bits) if b]


def balanced(rng, pairs, deep):
    bits, open_ = [True], 1
    while pairs or open_ > 1:
        if pairs and (open_ == 1 or rng.random() < deep):
            bits.append(True)
            pairs, open_ = pairs - 1, open_ + 1
        else:
            bits.append(False)
            open_ -= 1
    return np.array([*bits, False])


@pytest.mark.parametrize("block", [2, 4, 64])
def test_find_close(monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rng = np.random.default_rng(1)
    for pairs in (0, 1, 2, 3, 7, 40, 500, 1025):
        for deep in (0.2, 0.5, 0.9):
            bits = balanced(rng, pairs, deep)
            assert Parentheses(bits).find_close(np.flatnonzero(bits)).tolist() == by_stack(bits)


def brute(rows):
    """The contract, with tuples of turns as nodes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        full[c] = (*own.get(base, [])[:h], *turns[h:])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [u for u in members if u[: len(node)] == node]
        leaves = [u for u in below if not any(v[:-1] == u for v in members if len(v) == len(u) + 1)]
        ends = sorted(c for c in convs if len(full[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(1 for v in members if len(v) == len(node) + 1 and v[:-1] == node), len(leaves),
                    sum((len(members[u]) - 1) * len(u[-1][1].split()) for u in below if u),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, folder):
    return sorted(map(tuple, op12_prefix_trie(spark, folder).collect()), key=str)


@pytest.mark.parametrize("piece", [1, 7, 200_000])
def test_equals_brute_force(spark, tmp_dir, monkeypatch, piece):
    """Copies, paths that go on where others end, one hot first turn; pieces of one path up to whole shards."""
    monkeypatch.setattr(prefix_trie, "PIECE_TURNS", piece)
    rng = np.random.default_rng(5)
    rows = []
    for conv in range(90):
        length = int(rng.integers(1, 7))
        for turn in range(length):
            text = "hot first turn" if turn == 0 and conv % 3 else f"say {rng.integers(0, 2)} again"
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    rng.shuffle(rows)
    rows = [(int(c), int(t), r, x) for c, t, r, x in rows]
    assert result(spark, write(tmp_dir, conversations=rows)) == brute(rows)


def test_edges(spark, tmp_dir):
    rows = [
        (21, 0, "user", "a b"), (21, 0, "user", "a b"), (21, None, None, None), (20, 1, "user", "a b"), (20, None, None, ""),
        (-41, 0, "user", "x"), (-40, 0, "user", "y"), (None, 0, "user", "no conversation"), (7, 3, "user", LONG), (8, 3, "user", LONG),
        (9, 0, "us", "er a"), (10, 0, "user", " a"), (11, 0, "", "  \x0b z"),
    ]
    assert result(spark, write(tmp_dir, conversations=rows)) == brute(rows)
    assert result(spark, write(tmp_dir)) == []
    only_null = [(None, 0, "user", "no conversation")]
    assert result(spark, write(tmp_dir, conversations=only_null)) == []


def test_one_deep_conversation_and_turnless_ones(spark, tmp_dir):
    """Conversation 1 (h = 3) has two turns and no base: it is rebuilt without turns and ends at the root."""
    turnless = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(turnless, t, "user", "gone") for t in range(2)] + [(40, t, "user", f"t{t}") for t in range(3000)]
    got = op12_prefix_trie(spark, write(tmp_dir, conversations=rows)).collect()
    assert len(got) == 3001 and {r.depth for r in got} == set(range(3001))
    root = next(r for r in got if r.depth == 0)
    assert (root.conv_id, root.n_convs, root.n_children, root.n_leaves) == (turnless, 2, 1, 1)
    assert root.ends_sha256 == hashlib.sha256(str(turnless).encode()).hexdigest()


def test_whole_table_equals_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    res = con.sql(ORACLE_SQL["op12_prefix_trie"])
    df = op12_prefix_trie(spark, "/root/testdata/sf0.01").select(*res.columns)
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, res.fetchall()))
