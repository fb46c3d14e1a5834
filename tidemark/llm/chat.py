"""Chat formatting: transcripts parsed by a hidden Markov model, rendered as canonical turns.

A transcript is a sequence of lines.  The hidden states are (role, whether the line opens a turn);
a line is observed by its speaker marker, if any, and by features: a blank line before it, its
length, a question mark.  Viterbi's best path gives each line its role and the turn starts,
also where markers are missing, unknown or misleading.  Then each turn is rendered as
``<|role|>`` text ``<|end|>`` with the marker taken off and such tags in the text escaped.

The model's probabilities are smoothed counts over all labelled rows.  Viterbi's step is a
max-plus matrix product, so a transcript of any length is cut into chunks of ``CHUNK_ROWS``
rows: each chunk's product is a small matrix, the matrices' running product gives each
chunk's entry scores and whether a turn goes on behind it, and chunks are then decoded on their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, materialise

ROLES = ("system", "user", "assistant")
STATES = [(role, opens) for role in range(3) for opens in (True, False)]
CHUNK_ROWS = 1024
UNIT_ROWS = 5000
RANGE_ROWS = 50_000

#: Speaker names by role.
NAMES = {
    "system": "system instruction instructions context setup",
    "user": "user human customer me question q prompter you client",
    "assistant": "assistant ai bot model answer a gpt chatbot agent response",
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role].split()}
_MARKER = re.compile(r"^\s*(?:#{1,4}\s*|[*_]{1,2}|<\|?|\[|>\s*|-\s*)?\s*([A-Za-z][A-Za-z ]{0,19}?)\s*(?:\|?>|\]|[*_]{1,2}:|:[*_]{0,2}|\s-(?=\s))[:\s]*")
_TAG = re.compile(r"<(?=\|(?:system|user|assistant|end)\|>)")

#: Marker classes: none, one of each role, an unknown name.  Then the sizes of all features.
SIZES = (5, 2, 6, 2)


def marker_of(line: str) -> tuple[int, int]:
    """(marker class, its length) of a line."""
    m = _MARKER.match(line)
    if not m:
        return 0, 0
    role = _ROLE_OF.get(m[1].lower().strip())
    return (4 if role is None else 1 + role), m.end()


def features(line: str, after_blank: bool) -> tuple[int, ...]:
    marker, size = marker_of(line)
    body = line[size:]
    return marker, int(after_blank), min(5, len(body).bit_length() // 2), int(body.rstrip().endswith("?"))


def observed(text: str | None) -> list[tuple[str, tuple[int, ...]]]:
    """The lines of a text that are not blank, with their features."""
    out, blank = [], False
    for line in (text or "").split("\n"):
        if line.strip():
            out.append((line, features(line, blank)))
            blank = False
        else:
            blank = True
    return out


@dataclass
class Model:
    start: np.ndarray  # log probabilities of the first state
    move: np.ndarray  # of the next state
    emit: list[np.ndarray]  # by feature: state x value

    def lines(self, seen: list[tuple[int, ...]]) -> np.ndarray:
        """Log probability of each line under each state."""
        return sum(e[:, [s[f] for s in seen]].T for f, e in enumerate(self.emit))


def best_path(entry: np.ndarray, move: np.ndarray, lines: np.ndarray, rest: np.ndarray | float = 0.0) -> np.ndarray:
    """Viterbi's path; ``entry`` scores the first line's states before its features, ``rest`` what follows the last line."""
    score, back = entry + lines[0], np.zeros(lines.shape, np.int64)
    for t in range(1, len(lines)):
        step = score[:, None] + move
        back[t] = step.argmax(0)
        score = step.max(0) + lines[t]
    path = [int((score + rest).argmax())]
    for t in range(len(lines) - 1, 0, -1):
        path.append(int(back[t][path[-1]]))
    return np.array(path[::-1])


def chunk_product(move: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Best score of a chunk from each state of its first line to each state of its last."""
    total = np.where(np.eye(len(move), dtype=bool), lines[0], -np.inf)
    for row in lines[1:]:
        total = (total[:, :, None] + move).max(1) + row
    return total


def chunk_ends(start: np.ndarray, move: np.ndarray, products: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(entry, rest) of each chunk of a transcript: best scores before its first line and after its last."""
    entry, rest = [start], [np.zeros(len(start))]
    for p in products[:-1]:
        ends = (entry[-1][:, None] + p).max(0)
        after = (ends[:, None] + move).max(0)
        entry.append(after - after.max())
    for p in products[:0:-1]:
        before = (move + (p + rest[-1]).max(1)).max(1)
        rest.append(before - before.max())
    return list(zip(entry, rest[::-1]))


def chunk_closes(ends: list[tuple[np.ndarray, np.ndarray]], products: list[np.ndarray]) -> list[bool]:
    """Whether a chunk's last turn ends with it: the best path opens a turn in the next chunk, or there is none."""
    first = [int((entry + (p + rest).max(1)).argmax()) for (entry, rest), p in zip(ends, products)]
    return [STATES[i][1] for i in first[1:]] + [True]


def with_places(rows: DataFrame) -> DataFrame:
    """(row, hash, pos, text) with each row's place among its key's rows, counted from 0.

    Rows are range-partitioned in their order, so a key of any size lies over many tasks; a place is
    the number within its range plus the running total of the ranges before.
    """
    rows = rows.withColumn("start", F.substring("text", 1, 64)).withColumn("told", F.xxhash64("text"))
    order = ["hash", F.asc_nulls_first("pos"), "start", "told", "row"]
    ranged = rows.repartitionByRange(blocks_for(rows.count(), RANGE_ROWS), *order)
    ranged = materialise(ranged.withColumn("range", F.spark_partition_id()), "chat-ranges")
    sizes = ranged.groupBy("hash", "range").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = materialise(sizes.select("hash", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")), "chat-before")
    here = F.row_number().over(Window.partitionBy("hash", "range").orderBy(*order[1:]))
    placed = ranged.withColumn("here", here).join(before, ["hash", "range"])
    return placed.select("row", "hash", "text", (F.col("before") + F.col("here") - 1).alias("place"))


def count_rows(turns: DataFrame) -> tuple[dict, dict]:
    """Counts by Spark over labelled rows (conv_id, turn, role, text): of (state, feature, value) and of role successions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                for i, (_, seen) in enumerate(observed(text)):
                    state = STATES.index((ROLES.index(role), i == 0))
                    for f, v in enumerate(seen):
                        held[state, f, v] = held.get((state, f, v), 0) + 1
        names = ["state", "feature", "value", "n"]
        yield pa.RecordBatch.from_arrays([pa.array([*c], pa.int64()) for c in zip(*((*k, n) for k, n in held.items()))] or [pa.array([], pa.int64())] * 4, names=names)

    known = turns.where(F.col("role").isin(*ROLES))
    cells = known.select("role", "text").mapInArrow(count, "state long, feature long, value long, n long")
    cells = cells.groupBy("state", "feature", "value").agg(F.sum("n").alias("n"))
    one = known.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    one = materialise(one, "chat-turns")
    after = one.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    pairs = one.join(after, ["conv_id", "turn"], "left").groupBy("before", "role").count()
    return {tuple(r[:3]): r[3] for r in cells.collect()}, {(r[0], r[1]): r[2] for r in pairs.collect()}  # tens of rows


def fit(turns: DataFrame) -> Model:
    """The model of labelled turns; without any, all probabilities are even."""
    cells, pairs = count_rows(turns)
    emit = []
    for f, size in enumerate(SIZES):
        table = np.ones((len(STATES), size))
        for (state, feature, value), n in cells.items():
            if feature == f:
                table[state, value] += n
        emit.append(np.log(table / table.sum(1, keepdims=True)))
    opened = np.array([[sum(n for (s, f, _), n in cells.items() if f == 0 and STATES[s] == (r, o)) for o in (True, False)] for r in range(3)])
    goes_on = (opened[:, 1] + 1) / (opened.sum(1) + 2)
    follow = np.ones((4, 3))
    for (before, role), n in pairs.items():
        follow[3 if before is None else ROLES.index(before), ROLES.index(role)] += n
    follow /= follow.sum(1, keepdims=True)
    move, start = np.full((len(STATES),) * 2, -np.inf), np.full(len(STATES), -np.inf)
    for i, (r, _) in enumerate(STATES):
        for j, (q, opens) in enumerate(STATES):
            if opens:
                move[i, j] = np.log((1 - goes_on[r]) * follow[r, q])
            elif q == r:
                move[i, j] = np.log(goes_on[r])
        if STATES[i][1]:
            start[i] = np.log(follow[3, r])
    return Model(start, move, emit)


def render(lines: list[tuple[str, tuple[int, ...]]], path: np.ndarray, closes: bool) -> str:
    """Canonical turns of a row's lines; ``closes`` ends the last turn."""
    out: list[str] = []
    for i, ((line, _), state) in enumerate(zip(lines, path)):
        role, opens = STATES[state]
        if opens:
            if i:
                out.append("<|end|>\n")
            out.append(f"<|{ROLES[role]}|>")
            line = line[marker_of(line)[1] :]
        elif i:
            out.append("\n")
        out.append(_TAG.sub("&lt;", line))
    return "".join(out) + ("<|end|>" if closes and lines else "")


def parse_transcripts(rows: DataFrame, model: Model) -> DataFrame:
    """row, roles (one per line that is not blank) and rendered, for each row of ``rows`` (a unique long row, key, pos, text).

    The rows of a key, in the order of ``pos`` (null first), the text's first 64 characters, its hash and
    row, are one transcript, cut every ``CHUNK_ROWS`` counted rows; a cut changes nothing in the result.  A
    text may hold any number of lines.  Rows without text render as the empty string; null keys are
    one transcript; repeated rows are repeated lines; other columns are ignored; an empty table
    gives no rows.
    """
    plain = rows.select("row", F.xxhash64("key").alias("hash"), F.col("pos").cast("long").alias("pos"), F.coalesce("text", F.lit("")).alias("text"))
    placed = with_places(materialise(plain, "chat-rows"))
    plain = materialise(placed.withColumn("chunk", F.floor(F.col("place") / CHUNK_ROWS).cast("long")), "chat-places")
    units = blocks_for(plain.count(), UNIT_ROWS)
    dealt = plain.withColumn("unit", F.pmod(F.xxhash64("hash", "chunk"), F.lit(units)))

    def chunks(frame: pd.DataFrame):
        frame = frame.sort_values(["hash", "place"], kind="stable")
        for key, group in frame.groupby(["hash", "chunk"], sort=False):
            yield key, group, [observed(t) for t in group["text"]]

    def products(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (h, c), _, texts in chunks(frame):
            if seen := [f for text in texts for _, f in text]:
                out.append((h, c, chunk_product(model.move, model.lines(seen)).ravel().tolist()))
        return pd.DataFrame(out, columns=["hash", "chunk", "product"])

    def ends(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        tables = [np.array(p).reshape(len(STATES), -1) for p in frame["product"]]
        found = chunk_ends(model.start, model.move, tables)
        return pd.DataFrame({"hash": frame["hash"], "chunk": frame["chunk"], "entry": [e.tolist() for e, _ in found],
                             "rest": [r.tolist() for _, r in found], "closes": chunk_closes(found, tables)})

    def decode(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group, texts in chunks(frame):
            entry, rest, ends_turn = (group[c].iloc[0] for c in ("entry", "rest", "closes"))
            ends_turn = entry is None or bool(ends_turn)
            entry, rest = (model.start, 0.0) if entry is None else (np.array(entry), np.array(rest))
            seen = [f for text in texts for _, f in text]
            path = best_path(entry, model.move, model.lines(seen), rest) if seen else np.empty(0, np.int64)
            at = 0
            for row, text in zip(group["row"], texts):
                states = path[at : at + len(text)]
                at += len(text)
                closes = ends_turn if at >= len(path) else STATES[path[at]][1]
                out.append((row, [ROLES[STATES[s][0]] for s in states], render(text, states, closes)))
        return pd.DataFrame(out, columns=["row", "roles", "rendered"])

    long = materialise(plain.where("chunk <> 0").select("hash").distinct(), "chat-long")
    parts = dealt.join(long, "hash", "left_semi").groupBy("unit").applyInPandas(products, "hash long, chunk long, product array<double>")
    known = parts.groupBy("hash").applyInPandas(ends, "hash long, chunk long, entry array<double>, rest array<double>, closes boolean")
    dealt = dealt.join(materialise(known, "chat-ends"), ["hash", "chunk"], "left")
    return dealt.groupBy("unit").applyInPandas(decode, "row long, roles array<string>, rendered string")


#: Markers of the dialects in which labelled turns are written as transcripts: system, user, assistant.
DIALECTS = (
    ("System: ", "User: ", "Assistant: "),
    ("### Instructions: ", "### Human: ", "### AI: "),
    ("[system] ", "[customer] ", "[agent] "),
    ("<|system|> ", "<|user|> ", "<|assistant|> "),
)


def as_transcripts(turns: DataFrame) -> DataFrame:
    """Labelled turns (conv_id, turn, role, text) as a transcript's texts: a dialect per conversation, every eighth marker missing.

    Two of the dialects put a blank line before a turn.  Null texts and unknown roles have no marker.
    """
    dialect = F.pmod(F.xxhash64("conv_id"), F.lit(len(DIALECTS)))
    marker = F.lit("")
    for d, names in enumerate(DIALECTS):
        for role, name in zip(ROLES, names):
            marker = F.when((dialect == d) & (F.col("role") == role), name).otherwise(marker)
    marker = F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0, "").otherwise(marker)
    blank = F.when(dialect < 2, "\n").otherwise("")
    return turns.withColumn("text", F.concat(blank, marker, F.col("text").cast("string")))


def recover_turns(turns: DataFrame, row: str) -> DataFrame:
    """conv_id, turn, role, held_out, n_lines, right_lines, rendered of labelled turns written as transcripts and parsed again.

    The model is fitted on conversations whose crc32 modulo 3 is not 1; the others are held out.
    ``turns`` is a written table with a unique long ``row``; ``role`` is the label, ``right_lines`` counts
    the lines that got it.
    """
    held = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))) % 3 == 1
    texts = as_transcripts(turns.select(row, "conv_id", "turn", F.col("role").cast("string").alias("role"), "text"))
    model = fit(texts.where(~held))
    rows = texts.select(F.col(row).alias("row"), F.col("conv_id").alias("key"), F.col("turn").alias("pos"), "text")
    parsed = parse_transcripts(rows, model)
    facts = turns.select(F.col(row).alias("row"), "conv_id", "turn", F.col("role").cast("string").alias("role"), held.alias("held_out"))
    right = F.size(F.filter("roles", lambda r: r == F.col("role")))
    return facts.join(parsed, "row").select(
        "conv_id", "turn", "role", "held_out", F.size("roles").alias("n_lines"), F.greatest(right, F.lit(0)).alias("right_lines"), "rendered"
    )
