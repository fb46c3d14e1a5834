"""N-gram Jaccard join over prefix trees.

Documents are sets of k-word shingles; two link when |A and B| / |A or B| reaches num / den.
Equal sets are one node.  The join has two parts.

*Where a pair can be.*  Tokens have one global order: rare before frequent, then by hash.  Linked
sets share a token among the first ``n - ceil(t n) + 1`` of either, so only those need to meet.
Rarity is exact, counted over all nodes, first in the lowest ``1.5 (1 - t)`` of the hash space; a
token of more than ``RARE`` nodes is frequent.  Nodes that meet at rare tokens make candidates if
the tokens they share there leave room for a link.  Nodes with too few rare tokens there are
counted over the rest of the hash space among themselves.  What then still lacks rare tokens are
large groups of sets made of frequent tokens: those link to the hubs of their first ``HUB_ROUNDS``
frequent tokens, and node sets that stay apart though they share such a token are joined block by
block, so no link is lost and no task holds a group.

*Whether they link.*  Each task stores its sets in a prefix tree, the tokens most common there
first, so similar sets share their path.  A probe walks the tree and carries the overlap of
the path, computed once for all sets below; a subtree is skipped when the overlap and the longest
rest below cannot reach what the shortest set below needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, components, free_name, materialise, pieces_of, sets_of, small

RARE = 16
HUB_ROUNDS = 3  # hubs of so many first tokens
BLOCK_SETS = 512
UNIT_PAIRS = 2000

SET_SCHEMA = "n long, node long, r long, tokens array<long>"


class PrefixTree:
    """Token sets in order, each with the depth it shares with the one before: the tree's paths.

    ``end[i]`` closes the subtree that branches off at set ``i``; ``longest`` and ``shortest`` are set sizes in it.
    """

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        self.vocabulary, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
        self.rank, cuts = rank, np.cumsum([len(s) for s in sets])
        paths = [np.sort(p) for p in np.split(rank[inverse], cuts[:-1])] if sets else []
        self.order = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u4").tobytes())
        self.paths = [paths[i] for i in self.order]
        self.shared = [0] * len(paths)
        for i in range(1, len(paths)):
            a, b = self.paths[i - 1], self.paths[i]
            m = min(len(a), len(b))
            unlike = a[:m] != b[:m]
            self.shared[i] = int(unlike.argmax()) if unlike.any() else m
        size = [len(p) for p in self.paths]
        self.end, self.longest, self.shortest = list(range(1, len(size) + 1)), size[:], size[:]
        for i in range(len(size) - 1, -1, -1):
            j = i + 1
            while j < len(size) and self.shared[j] > self.shared[i]:
                self.longest[i], self.shortest[i] = max(self.longest[i], self.longest[j]), min(self.shortest[i], self.shortest[j])
                j = self.end[j]
            self.end[i] = j

    def probe(self, tokens: np.ndarray, num: int, den: int, skip=None) -> Iterator[int]:
        """Sets (as numbered at the start) that link with ``tokens``; ``skip(i)`` leaves one out."""
        mask = np.zeros(len(self.vocabulary), np.int64)
        if len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, tokens), len(self.vocabulary) - 1)
            mask[self.rank[at[self.vocabulary[at] == tokens]]] = 1
        n, i = len(tokens), 0
        overlap = np.zeros(max(map(len, self.paths), default=0) + 1, np.int64)  # of the path down to each depth
        while i < len(self.paths):
            depth = self.shared[i]
            held = int(overlap[depth])
            if (held + min(n - held, self.longest[i] - depth)) * (num + den) < num * (n + self.shortest[i]):
                i = self.end[i]
                continue
            path = self.paths[i]
            overlap[depth + 1 : len(path) + 1] = held + np.cumsum(mask[path[depth:]])
            both = int(overlap[len(path)])
            if den * both >= num * (n + len(path) - both) and not (skip and skip(self.order[i])):
                yield self.order[i]
            i += 1


def shingle_sets(docs: DataFrame, keys: list[str], k: int, share: float) -> DataFrame:
    """The keys of each document, its set size n, the set's own hash (node) and its r tokens in the lowest ``share`` of the hash space."""
    below = int(share * 2**63)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            m = batch.num_rows
            n, node, low = np.zeros(m, np.int64), [None] * m, [None] * m
            for i, h in sets_of(batch.column("text"), k):
                tokens = (h >> np.uint64(1)).astype(np.int64)
                n[i], node[i], low[i] = len(tokens), _set_hash(h), tokens[: np.searchsorted(tokens, below)].copy()
            r = [0 if x is None else len(x) for x in low]
            made = [pa.array(n), pa.array(node, pa.int64()), pa.array(r, pa.int64()), pa.array(low, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *made], names=[*keys, "n", "node", "r", "tokens"])

    rows = docs.select(*keys, F.col("text").cast("string").alias("text"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(sets, ", ".join(f"`{c}` {kinds[c]}" for c in keys) + f", {SET_SCHEMA}")


def _set_hash(h: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        a = (h * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) ^ (h ^ (h >> np.uint64(29))).sum(dtype=np.uint64)
        return int((a + np.uint64(len(h))) >> np.uint64(1))


def _full_sets(docs: DataFrame, keys: list[str], nodes: DataFrame, k: int, least: int = 0) -> DataFrame:
    """(node, tokens) of nodes (node, rep): all tokens from ``least`` on, from the text of the row with the keys ``rep``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_pylist()
            for i, h in sets_of(batch.column("text"), k):
                tokens = (h >> np.uint64(1)).astype(np.int64)
                tokens = tokens[np.searchsorted(tokens, least) :]
                yield pa.RecordBatch.from_arrays([pa.array([node[i]]), pa.array([tokens], pa.list_(pa.int64()))], names=["node", "tokens"])

    wanted = small(materialise(nodes.select("node", *[F.col("rep")[c].alias(f"rep_{c}") for c in keys]), "join-wanted"))
    rows = docs.select(*keys, F.col("text").cast("string").alias("text"))
    rows = rows.join(wanted, [F.col(c).eqNullSafe(F.col(f"rep_{c}")) for c in keys]).select("node", "text")
    found = materialise(rows.mapInArrow(sets, "node long, tokens array<long>"), "join-sets")
    if found.count() > wanted.count():  # repeated rows of equal keys
        found = materialise(found.groupBy("node").agg(F.first("tokens").alias("tokens")), "join-sets")
    return found


def _lists(tokens: DataFrame) -> DataFrame:
    """(token, nodes) of tokens of several nodes; the list of a frequent token ends at RARE + 1 nodes, its mark."""
    place = F.row_number().over(Window.partitionBy("token").orderBy("node"))
    few = tokens.withColumn("place", place).where(F.col("place") <= RARE + 1)
    lists = few.groupBy("token").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    return materialise(lists.where(F.size("nodes") > 1), "join-lists")


def _pairs(lists: DataFrame) -> DataFrame:
    """(a, b, common): rare tokens that two nodes share; a list has at most RARE nodes."""
    rare = lists.where(F.size("nodes") <= RARE)
    rest = F.transform("nodes", lambda a, i: F.transform(F.slice("nodes", i + 2, F.lit(RARE)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    pairs = rare.select(F.explode(F.flatten(rest)).alias("p")).select("p.a", "p.b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("common"))


def _needed(a: Column, b: Column, num: int, den: int) -> Column:
    """Least overlap of linked sets of sizes a and b."""
    return F.ceil((F.lit(num) * (a + b)) / F.lit(float(num + den)) - 1e-9)


def _prefix(n: Column, num: int, den: int) -> Column:
    return n - F.ceil(F.lit(num) * n / F.lit(float(den)) - 1e-9) + 1


def _links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link: sets b in prefix trees, probed by a.  A node of many pairs has several trees."""
    pairs = materialise(pairs, "join-pairs")
    total = pairs.count()
    units = blocks_for(total, UNIT_PAIRS)
    chunks = materialise(pairs.groupBy("a").agg(F.ceil(F.count("*") / 256.0).cast("long").alias("chunks")), "join-chunks")
    dealt = pairs.join(chunks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    dealt = materialise(dealt, "join-dealt")
    members = dealt.join(sets, dealt["b"] == sets["node"]).select("a", "chunk", "node", "tokens")
    probes = dealt.select("a", "chunk").distinct().join(sets, F.col("a") == sets["node"]).select("a", "chunk", "node", "tokens")
    rows = members.unionByName(probes).withColumn("unit", F.pmod(F.xxhash64("a", "chunk"), F.lit(units)))

    def verify(table: pa.Table) -> pa.Table:
        a, chunk, node = (table.column(c).to_numpy() for c in ("a", "chunk", "node"))
        tokens = _arrays(table)
        out: list[tuple[int, int]] = []
        order = np.lexsort((chunk, a))
        cuts = np.flatnonzero((np.diff(a[order]) != 0) | (np.diff(chunk[order]) != 0)) + 1
        for group in np.split(order, cuts):
            probe = [i for i in group if node[i] == a[i]]
            others = [i for i in group if node[i] != a[i]]
            tree = PrefixTree([tokens[i] for i in others])
            out += [(int(a[probe[0]]), int(node[others[j]])) for j in tree.probe(tokens[probe[0]], num, den)]
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return materialise(rows.groupBy("unit").applyInArrow(verify, "a long, b long"), "join-links")


def _arrays(table: pa.Table) -> list[np.ndarray]:
    lists = table.column("tokens").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [values[x:y] for x, y in zip(offsets[:-1], offsets[1:])]


def _blocks(apart: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between nodes of one cluster and different components; ``apart`` has (cluster, node, component).

    A cluster's nodes are dealt to blocks of some BLOCK_SETS, and each pair of blocks is one group:
    sets of one block in a tree, probed by the other's.  Pairs of one component need no look.
    """
    sizes = materialise(apart.groupBy("cluster").agg(F.ceil(F.count("*") / float(BLOCK_SETS)).cast("int").alias("blocks")), "join-clusters")
    dealt = apart.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    rows = materialise(dealt, "join-blocks").join(sets, "node").select("cluster", "i", "j", "block", "node", "component", "tokens")

    def join(table: pa.Table) -> pa.Table:
        block, node, component = (table.column(c).to_numpy() for c in ("block", "node", "component"))
        tokens, i, j = _arrays(table), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        parent = {int(c): int(c) for c in component}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        stored = np.flatnonzero(block == j)
        tree, out = PrefixTree([tokens[x] for x in stored]), []
        for x in np.flatnonzero(block == i):
            for y in tree.probe(tokens[x], num, den, lambda y: root(int(component[stored[y]])) == root(int(component[x]))):
                parent[root(int(component[stored[y]]))] = root(int(component[x]))
                out.append((int(node[x]), int(node[stored[y]])))
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return materialise(rows.groupBy("cluster", "i", "j").applyInArrow(join, "a long, b long"), "join-block-links")


def node_links(docs: DataFrame, keys: list[str], k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(rows: keys, n, node; parts: node, component) by all links; nodes without links have no part.

    Links among the nodes of large groups of frequent tokens need not be found where other links
    join the same nodes; all others are.
    """
    share = min(1.0, 1.5 * (1 - num / den))
    found = shingle_sets(docs, keys, k, share).withColumn("sig", F.monotonically_increasing_id())
    found = materialise(found, "join-signatures")
    rows = found.select(*keys, "n", "node")
    least = num // (den - num) if num < den else 1 << 62  # smaller sets link with equal sets only
    nodes = found.where(F.col("n") >= least).groupBy("node").agg(
        F.min(F.struct("sig", *keys)).alias("rep"), F.first("n").alias("n"), F.first("r").alias("r")
    )
    nodes = materialise(nodes, "join-nodes")

    chosen = small(materialise(nodes.select(F.col("rep.sig").alias("sig")), "join-chosen"))
    tokens = found.select("sig", "node", "tokens").join(chosen, "sig").select("node", F.explode("tokens").alias("token"))
    lists = _lists(tokens)
    frequent = lists.where(F.size("nodes") > RARE).select("token")
    common = materialise(tokens.join(small(frequent), "token"), "join-frequent")
    hot = common.groupBy("node").agg(F.count("*").alias("hot"))
    facts = nodes.join(hot, "node", "left").fillna(0, ["hot"])
    facts = materialise(facts, "join-facts")
    pairs = _pairs(lists)

    rest = materialise(facts.where(F.col("r") - F.col("hot") < _prefix(F.col("n"), num, den)), "join-rest")
    lack = None
    if not rest.isEmpty():
        more = _full_sets(docs, keys, rest.select("node", "rep"), k, int(share * 2**63))
        tokens2 = more.select("node", F.explode("tokens").alias("token"))
        lists2 = _lists(tokens2)
        frequent2 = lists2.where(F.size("nodes") > RARE).select("token")
        common2 = materialise(tokens2.join(small(frequent2), "token"), "join-frequent")
        pairs = pairs.union(_pairs(lists2).withColumn("common", F.lit(0).cast("long")))
        rare2 = more.select("node", F.size("tokens").alias("r2")).join(
            common2.groupBy("node").agg(F.count("*").alias("hot2")), "node", "left"
        )
        lack = rest.join(rare2, "node", "left").fillna(0, ["r2", "hot2"])
        lack = lack.withColumn("lacks", _prefix(F.col("n"), num, den) - (F.col("r") - F.col("hot") + F.col("r2") - F.col("hot2")))
        lack = materialise(lack.where("lacks > 0").select("node", "n", "rep", "lacks"), "join-lack")
        if lack.isEmpty():
            lack = None

    pairs = pairs.groupBy("a", "b").agg(F.sum("common").alias("common"))
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "r", "hot")]), F.col(side) == F.col(f"node_{side}"))
    need = _needed(F.col("n_a"), F.col("n_b"), num, den)
    room = F.greatest(F.col("r_a") - F.col("n_a"), F.col("r_b") - F.col("n_b")) + need
    pairs = pairs.where((F.least("n_a", "n_b") >= need) & (F.col("common") + F.least("hot_a", "hot_b") >= room))
    pairs = materialise(pairs.select("a", "b"), "join-candidates")

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    if lack is not None:
        wanted = wanted.union(lack.select("node"))
    wanted = materialise(wanted.distinct().join(facts.select("node", "rep"), "node"), "join-wanted")
    sets = _full_sets(docs, keys, wanted, k)
    links = _links(pairs, sets, num, den)
    if lack is None:
        return rows, materialise(components(links), "join-components")

    first = F.row_number().over(Window.partitionBy("node").orderBy("token"))
    meets = common.union(common2.select("token", "node")).join(lack.select("node", "n", "lacks"), "node")
    meets = materialise(meets.withColumn("place", first).where("place <= lacks").select("token", "node", "n", "place"), "join-meets")
    here = meets.where(F.col("place") <= HUB_ROUNDS)
    hubs = materialise(here.groupBy("token").agg(F.min(F.struct(F.xxhash64("node"), "node")).alias("hub")), "join-hubs")
    star = here.join(hubs, "token").select(F.col("hub.node").alias("a"), F.col("node").alias("b")).where("a <> b").distinct()
    links = links.union(_links(star, sets, num, den))
    links = materialise(links, "join-links")
    known = materialise(components(links), "join-components")
    apart = meets.select("token", "node").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = materialise(apart, "join-apart")
    split = apart.groupBy("token").agg(F.min("node").alias("hub"), F.min("component").alias("x"), F.max("component").alias("y"))
    split = materialise(split.where("x <> y").select("token", "hub"), "join-split")
    if not split.isEmpty():
        open_rows = materialise(apart.join(split, "token"), "join-open")
        clusters = components(open_rows.select(F.col("node").alias("a"), F.col("hub").alias("b")))
        members = open_rows.select("node", "component").distinct().join(clusters.withColumnRenamed("component", "cluster"), "node")
        more = _blocks(materialise(members, "join-members"), sets, num, den)
        known = _merged(known, more)
    return rows, known


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links (a, b): those join components, of which there are far fewer than nodes."""
    ends = links
    for side in ("a", "b"):
        names = parts.select(F.col("node").alias(f"node_{side}"), F.col("component").alias(f"part_{side}"))
        ends = ends.join(names, F.col(side) == F.col(f"node_{side}"), "left").withColumn(side, F.coalesce(f"part_{side}", side))
    joined = materialise(components(ends.select("a", "b")), "join-merged")
    joined = joined.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    lone = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().join(parts, "node", "left_anti")
    rows = parts.union(lone.select("node", F.col("node").alias("component")))
    rows = rows.join(joined, F.col("component") == F.col("part"), "left")
    return materialise(rows.select("node", F.coalesce("whole", "component").alias("component")), "join-components")


def groups(docs: DataFrame, keys: list[str], k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The keys of each row of ``docs``, n_shingles and group.

    ``keys`` tell a row's text from any other's, whenever the rows are read again: a stored row number, or
    an id with a hash of the text.  ``group`` is one number per connected component of links, equal
    sets included; null for rows without words, which link with nothing.  Repeated rows are equal
    sets.  An empty table gives no rows; other columns are ignored.
    """
    rows, parts = node_links(docs, keys, k, num, den)
    joined = rows.join(small(parts), "node", "left")
    return joined.select(*keys, F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("group"))


def link_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id of the component, itself included) per row.

    Rows without words are components of their own.  A null doc_id is never a component's smallest
    unless all its ids are null.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    rows = materialise(groups(keyed, ["doc_id", "_text"], k, num, den), "join-rows")
    least = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    least = materialise(least.where("members > 1"), "join-least")
    return rows.join(least, "group", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without all but one row of each group: a row of the smallest doc_id, then of the smallest text hash.

    Rows without words stay; a null doc_id comes last; of rows that are equal in id and text one stays.
    """
    text = free_name(docs.columns, "_text")
    keyed = docs.withColumn(text, F.xxhash64("text"))
    keys = ["doc_id", text]
    found = groups(keyed.select(*keys, "text"), keys, k, num, den).where("group is not null")
    found = materialise(found.groupBy("group", *keys).agg(F.count("*").alias("rows")), "join-groups")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(text).alias("hash"))
    first = found.groupBy("group").agg(F.min(order).alias("first"), F.count("*").alias("keys")).where("keys > 1")
    first = materialise(first, "join-first")
    kept = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col(text) == F.col("first.hash"))
    other_id, other_hash = free_name(keyed.columns, "_id"), free_name(keyed.columns, "_hash")
    other = [F.col("doc_id").alias(other_id), F.col(text).alias(other_hash)]
    drop = small(materialise(found.join(first, "group").where(~kept).select(*other), "join-drop"))
    same = F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(text) == F.col(other_hash))
    left = keyed.join(drop, same, "left_anti")
    again = materialise(found.where("rows > 1").select(*other), "join-repeated")
    if not again.isEmpty():
        again = small(again)
        one = left.join(again, same, "left_semi").dropDuplicates(keys)
        left = left.join(again, same, "left_anti").unionByName(one)
    return left.drop(text)
