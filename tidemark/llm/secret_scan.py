"""Secret scans with a recursive decoding worklist.

The base rules scan a text; then every encoded part is unwrapped into a layer of its own and
scanned too: percent (URL) escapes, Unicode and character-reference escapes, base64, and what is
zlib-, gzip- or Zstandard-compressed inside base64, in one member or frame or several.  Layers are unwrapped again until
nothing new comes; a layer that was met before at the same place is not followed again, so
cycles end.  Each character of a layer knows the span of the original text that it comes from, so
all spans are code points of the original.

Most texts hold no rule's or encoding's mark.  That is found on whole Arrow buffers; only
texts with a mark are scanned one by one.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs_of, text_slices

#: The base rules, in the order of their kinds; the number is the least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX, LEAST_BASE64 = 12, 18, 16, 16
#: A decompressed layer may be this long; longer ones are not held but scanned as a stream.
LAYER_BYTES = 16 << 20
#: Of a stream, so much is scanned at once if it can be cut, and so much of a long line is decoded at once.
STREAM_BYTES, UNWRAP_BYTES = 4 << 20, 1 << 18

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|%u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});|(&[A-Za-z][A-Za-z0-9]{1,31};)")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_BASE64)
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n?|\n)[ \t]*+[A-Za-z0-9+/_-]++)++")
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_PART = re.compile(r"[/_-]")
_ODD = re.compile(r"([\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]+)")
_STRAY = re.compile("[\udc80-\udcff]")
_NO_TEXT = frozenset([*range(0x80, 0xC2), *range(0xF5, 0x100)])  # begin no UTF-8 character
_LINE = re.compile(r"[^\n]+")
_MARK = re.compile(rb"[%\\&]")
_BASE64_BYTE = re.compile(rb"[A-Za-z0-9+/_-]")
_NOT_BASE64 = re.compile(rb"[^A-Za-z0-9+/_-]+")
_RUN_END = re.compile(rb"[!-*,.:-@\[-^`{-~\xc2-\xf4]|(?<!\s)[ \t]+(?=[^\s])")
_LAST_WORD = re.compile(rb"(?:[^\sA-Za-z0-9+/_-]|[^\s][ \t])([A-Za-z0-9+/_-]+)\Z")
_FIRST_WORD = re.compile(rb"([A-Za-z0-9+/_-]+)(?:[^\sA-Za-z0-9+/_-]|[ \t]+[^\s])")
_START = re.compile(rb"(?:^|[/_-]|[\r\n][ \t]*)(?=[A-Za-z0-9+/_-])")

SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_streamed long"


class Streamed:
    """What was found in a layer too long to be held: the kinds, and the span that it comes from."""

    def __init__(self, kinds: set[int], begin: int, end: int):
        self.kinds, self.begin, self.end = kinds, begin, end


class Same:
    """A sequence of one value."""

    def __init__(self, value: int, size: int):
        self.value, self.size = value, size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i):
        return Same(self.value, len(range(self.size)[i])) if isinstance(i, slice) else self.value

    def __iter__(self) -> Iterator[int]:
        return repeat(self.value, self.size)


class Layer:
    """A text with, for each character, its place in the original."""

    def __init__(self, text: str, begin: array | range | Same, end: array | range | Same):
        self.text, self.begin, self.end = text, begin, end

    def span(self, a: int, z: int) -> tuple[int, int]:
        return min(self.begin[a], self.begin[z - 1]), max(self.end[a], self.end[z - 1])

    def part(self, a: int, z: int) -> Layer:
        return Layer(self.text[a:z], self.begin[a:z], self.end[a:z])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by the base rules: the leftmost matches of each kind, less those that are too short."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]  # runs of all hex digits, as greedy matches are
    return sorted(found, key=lambda s: (s[0], s[2]))


def _wide(data: bytes) -> str | None:
    """The UTF-16 that bytes are in: by their mark, or by zeros in every other place."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16-le" if data[:1] == b"\xff" else "utf-16-be"
    head = data[:4096]
    low, high = head[0::2].count(0), head[1::2].count(0)
    if len(head) >= 8 and max(low, high) * 4 > len(head) // 2 * 3 and min(low, high) * 20 < len(head):
        return "utf-16-le" if high > low else "utf-16-be"
    return None


def _is_text(text: str) -> bool:
    """The one rule for held and for streamed layers: at most a tenth is not valid or not printable."""
    return bool(text) and (text.count("\ufffd") + sum(map(len, _ODD.findall(text)))) * 10 <= len(text)


def _readable(data: bytes) -> str | None:
    """Decoded bytes as UTF-8, if they are text; a byte that is not valid stays as a lone surrogate."""
    text = data.decode(errors="surrogateescape")
    return text if _is_text(_clean(text)) else None


def _clean(text: str) -> str:
    return _STRAY.sub("\ufffd", text)


def _decoded(data: bytes) -> str | None:
    """The text of decoded bytes, if they are text: UTF-16 if they look like it, else UTF-8 with replacements."""
    wide = _wide(data)
    text = data.decode(wide, "replace").lstrip("\ufeff") if wide else _clean(data.decode(errors="surrogateescape"))
    return text if _is_text(text) else None


def _size(c: str) -> int:
    """Bytes of a character; a stray byte is one."""
    return 1 if "\udc80" <= c <= "\udcff" else len(c.encode())


class Inflated:
    """Iterates over what compressed bytes hold, in pieces of at most 8 MB, through all gzip members, zlib streams and zstd frames.

    Then ``rest`` is what follows them, or begins with a damaged one; what came before the damage is kept.
    """

    def __init__(self, data: bytes, more: Iterator[bytes] = iter(())):
        self.data, self.at, self.more = data, 0, more

    def _ahead(self, size: int) -> bytes:
        """The next ``size`` bytes, fewer at the end."""
        while len(self.data) - self.at < size and (piece := next(self.more, None)) is not None:
            self.data, self.at = self.data[self.at :] + piece, 0
        return self.data[self.at : self.at + size]

    @property
    def rest(self) -> bytes:
        return self.data[self.at :]

    def __iter__(self) -> Iterator[bytes]:
        while known := _format(self._ahead(4)):
            make, feed = known
            member = make()
            before = self.at
            try:
                while not member.eof and (fed := self._ahead(feed)):
                    piece = member.decompress(fed)
                    self.at += len(fed)
                    if piece:
                        yield piece
            except (zlib.error, zstandard.ZstdError):
                self.at = before
                return
            self.at -= len(member.unused_data)
            while self._ahead(1) == b"\0":  # gzip may be padded
                self.at += 1


def _format(head: bytes):
    """(decompressor, bytes to feed at once) for the first bytes of a known format; bounded input bounds the output."""
    if head[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31), 4096
    if head == b"\x28\xb5\x2f\xfd" or len(head) == 4 and head[0] & 0xF0 == 0x50 and head[1:] == b"\x2a\x4d\x18":
        return lambda: zstandard.ZstdDecompressor().decompressobj(), 256
    if len(head) > 2 and head[0] & 0x0F == 8 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj, 4096
    return None


def _inflated(data: bytes) -> tuple[bytes, bytes, set[int] | None]:
    """(decompressed bytes; the bytes that are in no known format; kinds found in what is longer than LAYER_BYTES, else None)."""
    source, out, size = Inflated(data), [], 0
    for piece in source:
        out.append(piece)
        size += len(piece)
        if size > LAYER_BYTES:
            kinds = _stream_kinds(lambda: iter(Inflated(data)))
            for _ in source:
                pass
            return b"", source.rest, kinds
    return b"".join(out), source.rest, None


def _stream_kinds(source: Callable[[], Iterator[bytes]]) -> set[int]:
    """Kinds of the secrets in a text and its layers that is too long to be held; ``source`` reads it from its begin.

    It is cut where no rule and no encoding goes on, and the pieces are scanned.  A line or a wrapped
    run longer than LAYER_BYTES is cut with an overlap for the rules, and is then read once more through
    its decoders as a stream of its own.
    """
    if wide := _wide(next(source(), b"")):
        narrow = source
        return _stream_kinds(lambda: _narrowed(narrow(), wide))
    kinds: set[int] = set()
    held, at, tail = b"", 0, b""
    line = run = None  # where a long line or wrapped block, and a long base64 run in it, begin
    marked = False
    pieces = source()
    while len(kinds) < len(KINDS):
        piece = next(pieces, None)
        held += piece or b""
        if piece is not None and len(held) < STREAM_BYTES:
            continue
        while held and len(kinds) < len(KINDS):
            cut = len(held) if piece is None else _line_cut(held)
            whole, inner = bool(cut), False
            if not whole:
                if len(held) <= LAYER_BYTES:
                    break
                line = at if line is None else line
                ends = []
                for near in (1 << 12, len(held)):
                    ends = ends or [m.start() for m in _RUN_END.finditer(held, max(1, len(held) - near)) if _no_escape(held, m.start())]
                inner, cut = bool(ends), ends[-1] if ends else len(held) - 64
            part = held[:cut]
            if run is not None and (stop := _RUN_END.search(part)) or run is not None and whole:
                kinds |= _run_kinds(source, run, at + (stop.start() if stop else cut))
                run = None
            if not whole and not inner and run is None and (first := _BASE64_BYTE.search(held)):
                run = at + first.start()
            kinds |= _text_kinds(tail + part)
            if line is not None:
                marked = marked or _MARK.search(part) is not None
                tail += part
                tail = (re.sub(b" +", b" ", tail) if b" " * 64 in tail else tail)[-256:]
            held, at = held[cut:], at + cut
            if whole and line is not None:
                if marked:
                    for unwrap in (unwrap_percent, unwrap_escapes):
                        if _unwrapped(source, line, at, unwrap, True):
                            kinds |= _stream_kinds(lambda a=line, z=at, u=unwrap: _unwrapped(source, a, z, u))
                line, marked, tail = None, False, b""
        if piece is None:
            break
    return kinds


def _narrowed(pieces: Iterator[bytes], wide: str) -> Iterator[bytes]:
    """UTF-16 pieces as UTF-8."""
    decoder = codecs.getincrementaldecoder(wide)("replace")
    for piece in pieces:
        yield decoder.decode(piece).encode("utf-8", "replace")


def _text_kinds(data: bytes) -> set[int]:
    text = _clean(data.decode(errors="surrogateescape"))
    if not _is_text(text):
        return set()
    return {kind for _, _, kind in scan_counted(text, placed=False)[1]}


def _line_cut(data: bytes) -> int:
    """The last line's start that no wrapped run crosses, 0 if there is none."""
    at = data.rfind(b"\n", 0, -1)
    while at >= 0:
        before, after = data[max(0, at - 256) : at].rstrip(b" \t\r"), data[at + 1 : at + 257].lstrip(b" \t")
        if before and after:
            if not (_BASE64_BYTE.match(before[-1:]) and _BASE64_BYTE.match(after)):
                return at + 1
            a, z = _LAST_WORD.search(before[-32:]), _FIRST_WORD.match(after)
            if a and z and len(a[1]) + len(z[1]) < LEAST_BASE64:  # two words, no run
                return at + 1
        at = data.rfind(b"\n", 0, at)
    return 0


def _no_escape(data: bytes, at: int) -> bool:
    """Whether no escape goes on at a place: one begins there, or none before it is near."""
    return data[at] in b"%\\&" or not _MARK.search(data, max(0, at - 12), at)


def _slice(pieces: Iterator[bytes], a: int, z: int) -> Iterator[bytes]:
    at = 0
    for piece in pieces:
        if at >= z:
            return
        if at + len(piece) > a:
            yield piece[max(0, a - at) : z - at]
        at += len(piece)


def _unwrapped(source, a: int, z: int, unwrap, only_whether: bool = False):
    """The stretch from a to z with its escapes decoded, in pieces that end before a mark; or whether it has any."""

    def decoded(data: bytes) -> Layer | None:
        text = data.decode(errors="replace")
        return unwrap(Layer(text, range(len(text)), range(1, len(text) + 1)))

    def pieces() -> Iterator[tuple[bytes, bool]]:
        held = b""
        for piece in _slice(source(), a, z):
            held += piece
            while len(held) > UNWRAP_BYTES:
                cut = max(held.rfind(m, 1, UNWRAP_BYTES) for m in (b"%", b"\\", b"&"))
                cut = cut if cut > 0 else UNWRAP_BYTES - 16
                while cut > 1 and held[cut] & 0xC0 == 0x80:
                    cut -= 1
                yield held[:cut]
                held = held[cut:]
        yield held

    if only_whether:
        return any(decoded(p) is not None for p in pieces())
    return ((new.text.encode("utf-8", "replace") if (new := decoded(p)) else p) for p in pieces())


def _base64_stream(pieces: Iterator[bytes], shift: int = 0) -> Iterator[bytes]:
    held = b""
    for piece in pieces:
        held += _NOT_BASE64.sub(b"", piece)
        if shift and len(held) >= shift:
            held, shift = held[shift:], 0
        size = len(held) // 4 * 4
        if size and not shift:
            yield _base64_bytes(held[:size].decode())
            held = held[size:]
    yield _base64_bytes(held.decode())


def _run_kinds(source, a: int, z: int) -> set[int]:
    """Kinds in what a long base64 run holds: text in each alignment, and what is compressed from a start on."""
    kinds: set[int] = set()
    for shift in range(4):
        kinds |= _stream_kinds(lambda: _base64_stream(_slice(source(), a, z), shift))
    held, at, opened = b"", a, set()
    for piece in chain(_slice(source(), a, z), [b""]):
        held += piece
        for m in _START.finditer(held):
            if m.end() + 4096 > len(held) and piece or at + m.end() in opened or (m.start() == 0 and m.end() == 0 and at > a):
                continue
            head = _base64_bytes(_NOT_BASE64.sub(b"", held[m.end() : m.end() + 4096]).decode())
            if _format(head[:4]) and any(True for _ in Inflated(head)):
                opened.add(at + m.end())
                begin = at + m.end()
                kinds |= _stream_kinds(lambda: iter(Inflated(b"", _base64_stream(_slice(source(), begin, z)))))
        if len(held) > 8192:
            held, at = held[-8192:], at + len(held) - 8192
    return kinds


def unwrap_percent(layer: Layer) -> Layer | None:
    """The layer with percent escapes decoded; a byte that is not valid UTF-8 becomes one replacement character."""

    def one(m: re.Match) -> list[tuple[str, int, int]]:
        out, at = [], m.start()
        for c in bytes.fromhex(m[0].replace("%", "")).decode(errors="surrogateescape"):
            size = 3 * _size(c)
            out.append((_clean(c), at, at + size))
            at += size
        return out

    return _replaced(layer, _PERCENT, one)


def unwrap_escapes(layer: Layer) -> Layer | None:
    """The layer with Unicode escapes and character references decoded; a surrogate pair is one character."""

    def one(m: re.Match) -> list[tuple[str, int, int]]:
        if m[8]:
            return [(c, m.start(), m.end()) for c in html.unescape(m[8])] if html.unescape(m[8]) != m[8] else _as_is(m)
        code = int(m[6]) if m[6] else int(next(x for x in (m[1], m[2], m[3], m[4], m[5], m[7]) if x), 16)
        return [(chr(code) if code < 0x110000 else m[0][0], m.start(), m.end())]

    out = _replaced(layer, _ESCAPE, one)
    if out is not None and re.search("[\ud800-\udfff]", out.text):
        chars, begin, end, i = [], array("q"), array("q"), 0
        while i < len(out.text):
            c = out.text[i]
            if "\ud800" <= c < "\udc00" and i + 1 < len(out.text) and "\udc00" <= out.text[i + 1] < "\ue000":
                c, step = (c + out.text[i + 1]).encode("utf-16", "surrogatepass").decode("utf-16"), 2
            else:
                c, step = ("\ufffd" if "\ud800" <= c < "\ue000" else c), 1
            chars.append(c)
            begin.append(out.begin[i])
            end.append(out.end[i + step - 1])
            i += step
        out = Layer("".join(chars), begin, end)
    return out


def _as_is(m: re.Match) -> list[tuple[str, int, int]]:
    return [(c, i, i + 1) for i, c in enumerate(m[0], m.start())]


def _replaced(layer: Layer, pattern: re.Pattern, one) -> Layer | None:
    chars: list[str] = []
    begin, end = array("q"), array("q")
    last = 0
    for m in pattern.finditer(layer.text):
        chars.append(layer.text[last : m.start()])
        begin.extend(layer.begin[last : m.start()])
        end.extend(layer.end[last : m.start()])
        for c, a, z in one(m):
            chars.append(c)
            begin.append(layer.begin[a])
            end.append(layer.end[z - 1])
        last = m.end()
    if not last:
        return None
    text = "".join(chars) + layer.text[last:]
    if text == layer.text:
        return None
    begin.extend(layer.begin[last:])
    end.extend(layer.end[last:])
    return Layer(text, begin, end)


def unwrap_base64(layer: Layer) -> Iterator[Layer | Streamed]:
    """A layer for each base64 run that decodes to text or to compressed text, also for runs wrapped over lines.

    Of a run that does not decode as a whole, what decodes from a line's start or after one of ``/-_`` is taken.
    """
    barren: set[str] = set()  # short runs that gave nothing need not be tried again
    for run, lines, places in _base64_runs(layer.text):
        if len(lines) == 1 and run in barren:
            continue
        empty = True
        for new in _run_layers(layer, run, lines, places):
            empty = False
            yield new
        if empty and len(lines) == 1 and len(run) <= 256 and len(barren) < 10_000:
            barren.add(run)


def _base64_runs(text: str) -> Iterator[tuple[str, list[int], list[int]]]:
    """(run, places in it where lines begin, the same places in the text) of single and of wrapped runs."""
    for m in _BASE64.finditer(text):
        yield m[0].rstrip("="), [0], [m.start()]
    if "\n" in text or "\r" in text:
        for m in _WRAPPED.finditer(text):
            lines, places, run, size = [], [], [], 0
            for line in _BASE64_LINE.finditer(text, m.start(), m.end()):
                lines.append(size)
                places.append(line.start())
                run.append(line[0])
                size += len(line[0])
            if size >= LEAST_BASE64:
                yield "".join(run), lines, places


def _base64_bytes(run: str) -> bytes:
    run = run[: len(run) - (len(run) % 4 == 1)]
    return base64.b64decode(run.replace("-", "+").replace("_", "/") + "=" * (-len(run) % 4))


def _run_layers(layer: Layer, run: str, lines: list[int], places: list[int]) -> Iterator[Layer | Streamed]:
    def place(i: int) -> int:
        k = bisect_right(lines, i) - 1 if len(lines) > 1 else 0
        return places[k] + i - lines[k]

    def mapped(text: str, start: int, at: int = 0) -> Layer:
        """The layer of a text whose first byte is byte ``at`` of what the run holds from ``start``."""
        if isinstance(layer.begin, Same) and isinstance(layer.end, Same):
            return Layer(_clean(text), Same(layer.begin.value, len(text)), Same(layer.end.value, len(text)))
        begin, end = array("q"), array("q")
        for c in text:  # byte i takes bits 8i to 8i + 8, six to a base64 character
            size = _size(c)
            begin.append(layer.begin[place(start + 8 * at // 6)])
            at += size
            end.append(layer.end[place(start + (8 * at + 5) // 6 - 1)])
        return Layer(_clean(text), begin, end)

    def unpacked(parts: tuple[bytes, ...], kinds: set[int] | None, start: int) -> Iterator[Layer | Streamed]:
        a, z = layer.span(place(start), place(len(run) - 1) + 1)
        if kinds is not None:
            yield Streamed(kinds, a, z)
        for part in parts:
            text = _decoded(part)
            if text:
                yield Layer(text, Same(a, len(text)), Same(z, len(text)))

    done = 0
    if len(run) % 4 != 1:
        data = _base64_bytes(run)
        plain, rest, kinds = _inflated(data)
        if plain or kinds is not None:
            done = 8 * (len(data) - len(rest)) // 6
        yield from unpacked((plain, rest if done else b""), kinds, 0)
        if done and (not rest or _decoded(rest)):
            return
        if not done and _wide(data) and (text := _decoded(data)):
            yield from unpacked((data,), None, 0)
            return
        if not done and (text := _readable(data)):
            yield mapped(text, 0)
            return
    until = [done] * 4  # by alignment, how far the run was read
    for start in sorted({0, *lines, *(m.end() for m in _PART.finditer(run))}):
        if start < until[start % 4] or len(run) - start < LEAST_BASE64:
            continue
        head = _base64_bytes(run[start : start + 8])
        if head[0] in _NO_TEXT and not _format(head[:4]):
            continue
        if _format(head[:4]) and any(True for _ in Inflated(_base64_bytes(run[start : start + 2048]))):
            plain, rest, kinds = _inflated(_base64_bytes(run[start:]))
            yield from unpacked((plain, rest), kinds, start)
        text = _leading_text(run, start)
        until[start % 4] = start + 8 * len(text.encode()) // 6
        at = 0
        for part in [text] if _decoded(text.encode()) else _ODD.split(text):
            size = len(part.encode())
            if size >= LEAST_BASE64 * 3 // 4 and not _ODD.fullmatch(part):
                yield mapped(part, start, at)
            at += size


def _leading_text(run: str, start: int) -> str:
    """The UTF-8 text that base64 from ``start`` begins with."""
    size = 64
    while True:
        data = _base64_bytes(run[start : start + size])
        try:
            text = data.decode()
        except UnicodeDecodeError as e:
            text = data[: e.start].decode()
            if e.start + 4 <= len(data):
                return text
        if start + size >= len(run):
            return text
        size *= 4


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """(base spans, all spans, layers unwrapped and held) of a text."""
    return scan_counted(text)[:3]


def scan_counted(text: str, placed: bool = True) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """What ``scan`` gives, and the number of layers too long to be held, which were scanned as streams.

    Unless ``placed``, the spans found in layers are not the places but only tell the kinds.
    """
    base = base_spans(text)
    spans, layers, streamed = set(base), 0, 0
    n = len(text)
    whole = Layer(text, range(n), range(1, n + 1)) if placed else Layer(text, Same(0, n), Same(1, n))
    seen: set[tuple] = set()
    work = [whole]
    while work:
        layer = work.pop()
        found = list(unwrap_base64(layer))
        for unwrap, marks in ((unwrap_percent, "%"), (unwrap_escapes, "\\&%")):
            if any(c in layer.text for c in marks):
                for line in _LINE.finditer(layer.text):
                    if any(c in line[0] for c in marks) and (new := unwrap(layer.part(line.start(), line.end()))):
                        found.append(new)
        for new in found:
            if isinstance(new, Streamed):
                streamed += 1
                spans.update((new.begin, new.end, kind) for kind in new.kinds)
                continue
            key = (hashlib.sha256(new.text.encode("utf-8", "replace")).digest(), new.span(0, len(new.text)))
            if key not in seen:
                seen.add(key)
                layers += 1
                spans.update((*new.span(a, z), kind) for a, z, kind in base_spans(new.text))
                work.append(new)
    return base, sorted(spans, key=lambda s: (s[0], s[2], s[1])), layers, streamed


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{z}" for a, z, kind in spans)


_HEX_BYTES = np.isin(np.arange(256), list(b"0123456789abcdef"))
_HEX_ANY = np.isin(np.arange(256), list(b"0123456789abcdefABCDEF"))
_BASE64_BYTES = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"))
_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_BLANK_BYTES = np.isin(np.arange(256), list(b" \t\r\n"))
_WORDS = (b"passw", b"secret", b"token", b"api")


def marked_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of a slice that hold a mark of a rule or of an encoding."""
    at = [_long_runs(_HEX_BYTES[data], offsets, LEAST_HEX), _long_runs(_BASE64_BYTES[data], offsets, LEAST_BASE64)]
    at.append(_wrapped_runs(data, offsets))
    raw = data.tobytes()
    low = raw.lower()
    at += [np.array(_places(low, w), np.int64) for w in _WORDS] + [np.array(_places(raw, b"AKIA"), np.int64)]
    percent = np.flatnonzero(data[:-2] == 0x25)
    at.append(percent[(_HEX_ANY[data[percent + 1]] & _HEX_ANY[data[percent + 2]]) | (data[percent + 1] == 0x75)])
    slash = np.flatnonzero(data[:-1] == 0x5C)
    at.append(slash[np.isin(data[slash + 1], list(b"uUx"))])
    refer = np.flatnonzero(data[:-1] == 0x26)
    at.append(refer[(data[refer + 1] == 0x23) | _LETTER[data[refer + 1]]])
    return np.unique(np.searchsorted(offsets, np.concatenate(at), side="right") - 1)


def _long_runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    start, end = runs_of(mask, offsets)
    return start[end - start >= least]


def _wrapped_runs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of runs that are long enough only when joined over single line breaks and indents."""
    solid = _BASE64_BYTES[data]
    start, end = runs_of(_BLANK_BYTES[data], offsets)
    breaks = [np.concatenate([[0], np.cumsum(data == b)]) for b in (0x0A, 0x0D)]
    lf, cr = ((n[end] - n[start]) for n in breaks)
    keep = (lf + cr > 0) & (lf <= 1) & (cr <= 1)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, start[keep], 1)
    np.add.at(edge, end[keep], -1)
    start, end = runs_of(solid | (np.cumsum(edge[:-1]) > 0), offsets)
    count = np.concatenate([[0], np.cumsum(solid)])
    return start[count[end] - count[start] >= LEAST_BASE64]


def _places(data: bytes, word: bytes) -> list[int]:
    out, at = [], data.find(word)
    while at >= 0:
        out.append(at)
        at = data.find(word, at + 1)
    return out


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_layers and n_streamed of every row of ``docs``.

    The counts and the digest are of the base spans, ``spans`` lists those and the spans found in
    layers.  ``n_streamed`` counts layers over LAYER_BYTES, which are not held but scanned as streams and
    are not in ``n_layers``; what they hold has the span of the run that they come from.  Null and empty texts have none; repeated rows give equal rows; null ids stay null;
    other columns are ignored; an empty table gives no rows.
    """
    nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            rows = [nothing] * batch.num_rows
            for lo, _, data, offsets in text_slices(texts):
                for r in marked_rows(data, offsets):
                    base, spans, layers, streamed = scan_counted(texts[lo + int(r)].as_py() or "")
                    n = [sum(s[2] == k for s in base) for k in range(3)]
                    rows[lo + int(r)] = (*n, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(spans), layers, streamed)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_streamed"]
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
