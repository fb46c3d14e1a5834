"""Small tables for the tests of the training-data operators."""

import pyarrow as pa
import pyarrow.parquet as pq

CLASHES = ["row", "_row", "node", "n", "r", "tokens", "size", "score", "rank", "class", "copies", "pool", "chunk", "a", "b", "key", "hash", "tie", "count", "_id", "_hash", "_leaked", "_text", "conv", "gram"]


def write(folder, docs=(), labels=(), pages=(), benchmark=(), conversations=(), clash=True):
    """Parquet tables under ``folder``; documents also have columns named like the operators' own."""

    def put(name, rows, schema, extra=()):
        columns = {f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)}
        columns |= {c: pa.array(["x"] * len(rows), pa.string()) for c in extra if c not in columns}
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")

    s, i = pa.string(), pa.int64()
    put("documents", docs, pa.schema([("doc_id", i), ("text", s), ("lang", s), ("source", s), ("n_chars", i)]), CLASHES if clash else ())
    put("labels", labels, pa.schema([("doc_id", i), ("quality", i), ("toxic", i)]))
    put("pages", pages, pa.schema([("page_id", i), ("url", s), ("html", s)]), ["sha", "first_id", "frame"])
    put("benchmark", benchmark, pa.schema([("item_id", i), ("text", s)]), ["row", "s"])
    put("conversations", conversations, pa.schema([("conv_id", i), ("turn", i), ("role", s), ("text", s)]), ["row", "pos"])
    return folder


LONG = " ".join(f"w{i}" for i in range(30_000))
EDGE_DOCS = [
    (1, "one two three four five six seven", "en", "a", 1),
    (1, "one two three four five six seven", "en", "a", 1),
    (2, "one two three four five six seven", "en", None, 1),
    (3, None, "en", "b", None),
    (4, "", None, "b", 0),
    (5, " \t\n\x0b ", "en", "b", 0),
    (None, "lonely words here", "de", "c", 1),
    (None, "lonely words here", "de", "c", 1),
    (6, LONG, "en", "c", 1),
    (7, "single", None, None, 1),
    (8, "ä" * 50_000, "fr", "a", 1),
]


def words(rng, n, vocabulary=4000):
    return [f"v{x}" for x in rng.integers(0, vocabulary, n)]


def thue_morse(swap):
    """One of two 1,024-letter words that many polynomial hashes modulo a power of two cannot tell apart."""
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(1024))
