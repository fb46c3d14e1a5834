"""Fill-in-the-middle: documents rearranged as piece tables.

A document is a list of descriptors (buffer, start, end) over immutable bytes: the text as it lies
in the Arrow batch, and one buffer of sentinels.  Cutting splits a descriptor in two, an
arrangement puts the pieces in another order with sentinels between them, and the inverse
arrangement restores the text.  Hashes are fed descriptor by descriptor, so no rearranged copy is
built for them.  Restoring starts from the output alone: its sentinels are found in the bytes.

Cuts are drawn from the document's id, so reruns and retried tasks agree and no row needs another.

Every row gives one row.  A null text counts as empty; an empty text, and one that holds a
sentinel, is ``plain``: the output is the text, and ``prefix_chars`` and ``middle_chars`` are null.
A null id draws as the empty text does, so all null ids have the same draws; equal rows give equal
results.  Columns other than id and text are not read.  A text is held twice at most (as it came
and, to be restored, as output), whatever its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of

#: The sentinels of prefix, suffix and middle, and the shares of the forms in percent.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
CHANGED_PERCENT = 90
SPM_PERCENT = 20

_SENTINELS = PREFIX + SUFFIX + MIDDLE
_MARK = {mark: _SENTINELS.index(mark) for mark in (PREFIX, SUFFIX, MIDDLE)}
_ANY = re.compile(b"|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))))
#: The order of the pieces in each form, each behind its sentinel; a form's pieces by their place in the text are the inverse.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
_IN_TEXT = (PREFIX, MIDDLE, SUFFIX)
_STRETCH = 1 << 16

SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Piece:
    buffer: memoryview
    start: int
    end: int

    def split(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.buffer, self.start, self.start + at), Piece(self.buffer, self.start + at, self.end)

    def view(self) -> memoryview:
        return self.buffer[self.start : self.end]


def sha256(pieces: list[Piece]) -> str:
    state = hashlib.sha256()
    for piece in pieces:
        state.update(piece.view())
    return state.hexdigest()


def joined(pieces: list[Piece]) -> bytes:
    return b"".join(piece.view() for piece in pieces)


def _starts(view: memoryview) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, whether each byte starts a code point) of the stretches of a text."""
    data = np.frombuffer(view, np.uint8)
    for at in range(0, len(data), _STRETCH):
        yield at, (data[at : at + _STRETCH] & 0xC0) != 0x80


def code_points(piece: Piece) -> int:
    return sum(int(np.count_nonzero(starts)) for _, starts in _starts(piece.view()))


def byte_places(piece: Piece, wanted: tuple[int, int]) -> list[int]:
    """Where the code points of the given ascending numbers start; the text's end for its length."""
    places, seen = [], 0
    for at, starts in _starts(piece.view()):
        here = int(np.count_nonzero(starts))
        while len(places) < len(wanted) and wanted[len(places)] < seen + here:
            places.append(at + int(np.flatnonzero(starts)[wanted[len(places)] - seen]))
        seen += here
    return places + [piece.end - piece.start] * (len(wanted) - len(places))


def draws(doc_id) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def arrange(text: Piece, doc_id) -> tuple[int, str, int | None, int | None, list[Piece]]:
    """(code points, form, prefix's and middle's code points, pieces of the output)."""
    n = code_points(text)
    h1, h2, h3, h4 = draws(doc_id)
    if n == 0 or h3 % 100 >= CHANGED_PERCENT or _ANY.search(text.view()):
        return n, "plain", None, None, [text]
    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = byte_places(text, (low, high))
    head, suffix = text.split(second)
    prefix, middle = head.split(first)
    parts = dict(zip(_IN_TEXT, (prefix, middle, suffix)))
    sentinels = memoryview(_SENTINELS)
    out = []
    for mark in ORDERS[form]:
        out += [Piece(sentinels, _MARK[mark], _MARK[mark] + len(mark)), parts[mark]]
    return n, form, low, high - low, out


def restore(output: bytes, form: str) -> list[Piece]:
    """The text's pieces, from the output and its form: sentinels are found, the arrangement inverted.

    Neither a sentinel's end nor its start can be part of another one, so the first match of each is the sentinel itself.
    """
    whole = Piece(memoryview(output), 0, len(output))
    if form == "plain":
        return [whole]
    marks = ORDERS[form]
    parts, rest = {}, whole
    for mark, following in zip(marks, (*marks[1:], None)):
        if bytes(rest.buffer[rest.start : rest.start + len(mark)]) != mark:
            raise ValueError(f"no {mark.decode()} where form {form} has one")
        rest = rest.split(len(mark))[1]
        end = rest.end if following is None else output.find(following, rest.start, rest.end)
        if end < 0:
            raise ValueError(f"no {following.decode()} in an output of form {form}")
        parts[mark], rest = rest.split(end - rest.start)
    return [parts[mark] for mark in _IN_TEXT]


def restore_text(output: str, form: str) -> str:
    return joined(restore(output.encode(), form)).decode()


def _texts(column: pa.Array) -> Iterator[Piece]:
    """The texts as pieces over the batch's own buffer; null is empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"").cast("B")
    for i in range(len(column)):
        yield Piece(data, int(offsets[i]), int(offsets[i + 1])) if column[i].is_valid else Piece(data, 0, 0)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", outputs: bool = True) -> DataFrame:
    """One row per document: its id, cuts, form, hashes and, with ``outputs``, the output text itself."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 256):
            columns: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
            texts = []
            for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                n, form, prefix, middle, out = arrange(text, doc_id)
                output = joined(out)
                values = (n, form, prefix, middle, sha256(out), sha256(restore(output, form)))
                for name, value in zip(columns, values):
                    columns[name].append(value)
                if outputs:
                    texts.append(output.decode())
            arrays = [batch.column(0)]
            arrays += [pa.array(v, pa.int64() if c in ("n", "prefix_chars", "middle_chars") else pa.string()) for c, v in columns.items()]
            if outputs:
                arrays.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=["_id", *columns, *(["output"] if outputs else [])])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_id {kind}, {SCHEMA}" + (", output string" if outputs else "")
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
