"""Conversation prefix trie: balanced parentheses per shard, shared spines merged.

A conversation is the sequence of its turns; a turn is the SHA-256 of its role and text, so a
conversation is one fixed-width binary path whose byte order is the trie's preorder.  Equal paths
become one row, with their count, smallest conversation and the hash of their ids.  The distinct
paths are dealt to shards by range.  A shard reads its paths in order and writes the trie of each
piece of them as balanced parentheses: ``(`` enters a node, ``)`` leaves it.  Blocks of the excess
(open minus closed) keep their minimum and maximum, so the parenthesis that closes a node
is found by skipping blocks; it delimits the subtree.  Leaves are ``()`` pairs, counted by rank;
members and tokens are differences of cumulative arrays over the preorder.

Only the nodes on a piece's first and last path, its spines, can be in another piece as well.  Every
figure is additive over pieces, as a node counts as new only where the path before it does not have
it.  So spines are summed by key.  A piece knows its neighbours within a shard; what a shard
assumed about the shard before and after it is corrected from the shards' first and last paths.

Null turns come first; equal turn numbers are ordered by the turn's hash, so reruns agree; repeated
rows are turns of their own.  A null role or text is empty.  Rows with a null conversation id belong to no
conversation and are left out.  An empty table gives no rows.  Columns other than the four are
not read.  A conversation's turns are held at once (about 100 bytes each), conversations that share turns
or are equal are not: the ids that end at a node are hashed in one sorted stream, as SHA-256 has to be.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, small

STEP = 32  # bytes of a turn in a path
PIECE_TURNS = 200_000  # turns of the paths of one piece
BLOCK = 64  # parentheses of an excess block
ROOT_KEY = bytes(STEP)
NO_ENDS = hashlib.sha256(b"").hexdigest()

PATH_SCHEMA = "path binary, words array<int>, n long, conv long, ends string"
NODE_SCHEMA = (
    "key binary, parent_key binary, depth long, conv long, parent_conv long, n_convs long, n_children long, n_leaves long, "
    "tokens long, words long, ends string, shard int, first binary, first_words array<int>, last binary, last_words array<int>"
)


class Parentheses:
    """A sequence of parentheses (true opens) with min-max blocks of its excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int64)
        blocks = -(-len(bits) // BLOCK)
        self._padded = np.concatenate([self.excess, np.full(blocks * BLOCK - len(bits), self.excess[-1])])
        grid = self._padded.reshape(blocks, BLOCK)
        self.levels = [(grid.min(1), grid.max(1))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            if len(low) % 2:
                low, high = np.append(low, low[-1]), np.append(high, high[-1])
                self.levels[-1] = low, high
            self.levels.append((low.reshape(-1, 2).min(1), high.reshape(-1, 2).max(1)))

    def _in_block(self, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place behind ``after``, in the block that comes next, with the target excess; -1 if none."""
        out = np.full(len(after), -1)
        for at in range(0, len(after), 1 << 14):
            here, goal = after[at : at + (1 << 14)], target[at : at + (1 << 14)]
            start = (here + 1) // BLOCK * BLOCK
            places = start[:, None] + np.arange(BLOCK)
            hit = (self._padded[places] == goal[:, None]) & (places > here[:, None]) & (places < len(self.bits))
            found = hit.any(1)
            out[at : at + (1 << 14)][found] = places[found, hit[found].argmax(1)]
        return out

    def _holds(self, level: int, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        inside = node < len(low)
        node = np.where(inside, node, 0)
        return inside & (low[node] <= target) & (target <= high[node])

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing place of each opening one: the first place behind it whose excess is one less than at it."""
        target = self.excess[opens] - 1
        out = self._in_block(opens, target)
        rest = np.flatnonzero(out < 0)
        goal, node = target[rest], opens[rest] // BLOCK + 1
        block = np.full(len(rest), -1)
        for level in range(len(self.levels)):  # up, to the first node to the right that holds the target
            open_ = np.flatnonzero(block < 0)
            if not len(open_):
                break
            hit = open_[self._holds(level, node[open_], goal[open_])]
            block[hit] = self._descend(level, node[hit], goal[hit])
            left = open_[(block[open_] < 0) & (node[open_] % 2 == 0)]
            sibling = left[self._holds(level, node[left] + 1, goal[left])]
            block[sibling] = self._descend(level, node[sibling] + 1, goal[sibling])
            node = node // 2 + 1
        out[rest] = self._in_block(block * BLOCK - 1, goal) if len(rest) else out[rest]
        return out

    def _descend(self, level: int, node: np.ndarray, goal: np.ndarray) -> np.ndarray:
        for below in range(level - 1, -1, -1):
            left = node * 2
            node = np.where(self._holds(below, left, goal), left, left + 1)
        return node

    def leaf_rank(self, counted: np.ndarray) -> np.ndarray:
        """Number of counted ``()`` pairs that open before each place."""
        return np.concatenate([[0], np.cumsum(counted)])


@dataclass
class Piece:
    """Consecutive distinct paths of a shard."""

    paths: list[bytes] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    conv: list[int] = field(default_factory=list)
    ends: list[str] = field(default_factory=list)
    turns: int = 0

    def add(self, path: bytes, words, n: int, conv: int, ends: str) -> None:
        self.paths.append(path)
        self.words.append(np.asarray(words, np.int64))
        self.n.append(n)
        self.conv.append(conv)
        self.ends.append(ends)
        self.turns += len(path) // STEP + 1


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns of the common prefix of two paths."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // STEP
    x, y = np.frombuffer(a, np.uint8, size), np.frombuffer(b, np.uint8, size)
    return int((x != y).argmax()) // STEP


def keys_of(path: bytes) -> list[bytes]:
    """The key of every node on a path, from the root down: each hashes the one before and the turn."""
    keys = [ROOT_KEY]
    for at in range(0, len(path), STEP):
        keys.append(hashlib.sha256(keys[-1] + path[at : at + STEP]).digest())
    return keys


def trie_of(piece: Piece, before: bytes | None, after: bytes | None) -> dict[str, list]:
    """The nodes of a piece's trie in preorder; a node on a spine has its key, one under a spine its parent's."""
    paths = piece.paths
    size = np.array([len(p) // STEP for p in paths])
    common = np.array([0, *(shared_turns(a, b) for a, b in zip(paths, paths[1:]))])
    fresh = size - common
    counts = np.empty(2 * len(paths) + 1, np.int64)  # closing and opening in turn; the root opens with the first path
    counts[0], counts[2:-1:2] = 0, size[:-1] - common[1:]
    counts[1::2], counts[-1] = fresh, size[-1] + 1
    counts[1] += 1
    bits = np.repeat(np.arange(len(counts)) % 2 == 1, counts)
    tree = Parentheses(bits)
    opens = np.flatnonzero(bits)
    closes = tree.find_close(opens)
    nodes = len(opens)
    stop = np.arange(nodes) + (closes - opens + 1) // 2  # preorder place behind the subtree
    depth = tree.excess[opens] - 1

    last_of = np.cumsum(fresh)  # preorder place of each path's last node
    word = np.zeros(nodes, np.int64)
    word[1:] = np.concatenate([w[c:] for w, c in zip(piece.words, common)])
    ends_here = np.zeros(nodes, np.int64)
    ends_here[last_of] = piece.n
    members = np.concatenate([[0], np.cumsum(ends_here)])
    n_convs = members[stop] - members[:-1]

    order = depth * (nodes + 1) + np.arange(nodes)
    by_depth = np.argsort(order, kind="stable")
    parent = np.full(nodes, -1)
    parent[1:] = by_depth[np.searchsorted(order[by_depth], order[1:] - (nodes + 1)) - 1]

    new = np.ones(nodes, bool)
    if before is not None:
        new[: shared_turns(before, paths[0]) + 1] = False
    children = np.bincount(parent[1:][new[1:]], minlength=nodes)
    pair = np.zeros(len(bits), bool)
    pair[:-1] = bits[:-1] & ~bits[1:]
    if after is not None and after.startswith(paths[-1]):
        pair[opens[last_of[-1]]] = False
    rank = tree.leaf_rank(pair)
    tokens = np.concatenate([[0], np.cumsum(n_convs * word)])
    own = np.concatenate([[0], np.cumsum(np.where(new, word, 0))])

    least = np.full(nodes, np.iinfo(np.int64).max)
    least[last_of] = piece.conv
    for d in range(int(depth.max()), 0, -1):
        level = by_depth[np.searchsorted(order[by_depth], d * (nodes + 1)) : np.searchsorted(order[by_depth], (d + 1) * (nodes + 1))]
        np.minimum.at(least, parent[level], least[level])

    key: list[bytes | None] = [None] * nodes
    first_depth = int(size[0]) if before is None else shared_turns(before, paths[0])
    for d, k in enumerate(keys_of(paths[0])[: first_depth + 1]):
        key[d] = k
    last_depth = int(size[-1]) if after is None else shared_turns(paths[-1], after)
    at = int(last_of[-1])
    spine = [at]
    while parent[spine[-1]] >= 0:
        spine.append(int(parent[spine[-1]]))
    for k, v in zip(keys_of(paths[-1])[: last_depth + 1], reversed(spine)):
        key[v] = k
    ends: list[str | None] = [None] * nodes
    for v, digest in zip(last_of, piece.ends):
        ends[v] = digest
    up = np.maximum(parent, 0)
    return {
        "key": key,
        "parent_key": [None if p < 0 else key[p] for p in parent],
        "depth": depth,
        "conv": least,
        "parent_conv": least[up],
        "n_convs": n_convs,
        "n_children": children,
        "n_leaves": rank[closes] - rank[opens],
        "tokens": tokens[stop] - tokens[:-1],
        "words": own[stop] - own[:-1],
        "ends": ends,
    }


def paths_of(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv, turns array<struct<turn, digest, words>>) of every conversation, its turns in order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(WORD)).cast("int")
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.struct(F.col("turn"), digest.alias("digest"), words.alias("words")).alias("t")
    )
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def share_heads(convs: DataFrame, every: int, most: int) -> DataFrame:
    """Every conversation c rebuilt to start with the first h turns of c - c % every, h being crc32(c) % (most + 1)."""
    base = F.col("conv") - F.col("conv") % every
    h = (F.crc32(F.col("conv").cast("string")) % (most + 1)).cast("int")
    heads = convs.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, most).alias("head"))
    rows = convs.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    none = F.slice("turns", 1, 0)
    rebuilt = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return rows.select("conv", rebuilt.alias("turns"))


def distinct_paths(convs: DataFrame) -> DataFrame:
    """One row per distinct path: its count, smallest conversation, and the hash of its conversations' ids in order."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, words, n, conv, state = None, None, 0, 0, hashlib.sha256()
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            rows = list(zip(*done)) if done else [[]] * 5
            done.clear()
            kinds = (pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(rows, kinds)], names=["path", "words", "n", "conv", "ends"])

        for batch in batches:
            held, ids = batch.column("path"), batch.column("conv").to_pylist()
            for i, c in enumerate(ids):
                here = held[i].as_py()
                if here != path:
                    if path is not None:
                        done.append((path, words, n, conv, state.hexdigest()))
                    path, words, n, conv, state = here, batch.column("words")[i].as_py(), 0, c, hashlib.sha256()
                state.update(f",{c}".encode() if n else str(c).encode())
                n += 1
            if done:
                yield flush()
        if path is not None:
            done.append((path, words, n, conv, state.hexdigest()))
        yield flush()

    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = convs.select("conv", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = rows.repartition("path").sortWithinPartitions("path", "conv")
    return materialise(rows.mapInArrow(merge, PATH_SCHEMA), "trie-paths")


def _batch(columns: dict[str, list], rows: int) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
    arrays, names = [], []
    for name, kind in (c.split() for c in NODE_SCHEMA.split(", ")):
        arrays.append(pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(rows, kinds[kind]))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def shard_tries(paths: DataFrame) -> DataFrame:
    """The nodes of all pieces of all shards, and one row per shard with its first and last path."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, before, first = Piece(), None, None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("path", "words", "n", "conv", "ends"))):
                row = [v.as_py() for v in row]
                if piece.turns >= PIECE_TURNS:
                    nodes = trie_of(piece, before, row[0])
                    yield _batch(nodes, len(nodes["depth"]))
                    before, piece = piece.paths[-1], Piece()
                if first is None:
                    first = row[0], row[1]
                piece.add(*row)
        if not piece.paths:
            return
        nodes = trie_of(piece, before, None)
        yield _batch(nodes, len(nodes["depth"]))
        edge = {"shard": TaskContext.get().partitionId(), "first": first[0], "first_words": first[1],
                "last": piece.paths[-1], "last_words": piece.words[-1].tolist()}
        yield _batch({k: [v] for k, v in edge.items()}, 1)

    rows = paths.repartitionByRange("path").sortWithinPartitions("path")
    return materialise(rows.mapInArrow(build, NODE_SCHEMA), "trie-nodes")


def seams(edges: DataFrame) -> DataFrame:
    """What shards counted twice, as negative rows: nodes the shard before has too, and its last leaf if it goes on.

    One row per shard meets in one window.
    """

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                last, first = batch.column("before")[i].as_py(), batch.column("first")[i].as_py()
                words = batch.column("first_words")[i].as_py()
                common = shared_turns(last, first)
                leaf = common == len(last) // STEP
                keys = keys_of(first[: common * STEP])
                again = np.cumsum([0, *words[:common]][::-1])[::-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array([-int(d < common) for d in range(common + 1)], pa.int64()),
                     pa.array([-int(leaf)] * (common + 1), pa.int64()), pa.array([-int(w) for w in again], pa.int64())],
                    names=["key", "n_children", "n_leaves", "words"])

    before = F.lag("last").over(Window.orderBy("shard"))
    pairs = edges.select("first", "first_words", before.alias("before")).where("before is not null")
    return pairs.mapInArrow(correct, "key binary, n_children long, n_leaves long, words long")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations (conv, turns), the root included."""
    rows = shard_tries(distinct_paths(convs))
    nodes = rows.where("shard is null").drop("shard", "first", "first_words", "last", "last_words")
    spines = nodes.where("key is not null").unionByName(seams(rows.where("shard is not null")), allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "tokens", "words")]
    some = [F.max(c).alias(c) for c in ("parent_key", "depth", "ends")]
    spines = materialise(spines.groupBy("key").agg(*sums, *some, F.min("conv").alias("conv")), "trie-spines")
    inner = nodes.where("key is null")
    rest = inner.where("parent_key is not null").drop("parent_conv").unionByName(spines)
    parents = small(spines.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv")))
    whole = inner.where("parent_key is null").unionByName(rest.join(parents, "parent_key", "left"))
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent_conv")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", (F.col("tokens") - F.col("words")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
