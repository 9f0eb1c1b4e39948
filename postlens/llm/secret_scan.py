"""Secrets in texts and in what is encoded inside them.

A worklist starts with the text itself. Every layer is scanned for secrets and
searched for encoded parts: URL escapes and Unicode escapes, which are decoded
in place, and base64 runs, which become layers of their own, after inflating
them if they hold compressed data, all streams that follow one another. A run is
read line by line and over line breaks: all lines that touch, and blocks of lines
of one width with the shorter line after them. New layers go back on the worklist until no
layer is left. A layer that was met before at the same place of the original is
not opened again, so data that unpack to themselves end; at another place it is.
All that a compressed part holds has the span of that part, so a part that
stands in many places is unpacked once. Every span is mapped back, layer by
layer, to code points of the original text.

Kinds: ``assign`` (a keyword, ``=`` or ``:``, and a value of six characters or
more), ``access`` (an access key id) and ``hex`` (24 hexadecimal digits or more).

Defined results: a null or empty text has no spans; repeated rows and null ids
are rows like others; further columns are not read. A decoded span that covers
the same characters as one found in the text itself is listed once, as the
latter. Decoded data are read as UTF-8, or else as Latin-1, and where they hold
16-bit characters also as UTF-16. A compressed layer that unpacks to more than
``LAYER_BYTES`` is read as a stream, in windows that overlap; what is encoded
inside it is opened if it lies within a window. ``unopened`` counts such layers,
and compressed data that end early or are broken, of which what could be unpacked
is scanned.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import map_columns

KINDS = ("assign", "access", "hex")
LAYER_BYTES = 1 << 26
PIECE = 1 << 20  # bytes unpacked at a time
WINDOW = 1 << 23  # bytes of a larger layer that are scanned at a time
OVERLAP = 1 << 16  # bytes of a window that the next one has again
SPANS = "array<struct<kind:string,start:int,end:int,layers:string>>"

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f][0-9a-f]{23,}")
URL = re.compile("(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
BASE64 = re.compile("(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n?|\n)[ \t>]*+[A-Za-z0-9+/_-]++)++")
LINE = re.compile("[A-Za-z0-9+/_-]+")
WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\0){4,}")
CONTROL = re.compile("[\0-\x08\x0e-\x1f\x7f]")

Span = tuple[int, int]
Up = Callable[[int, int], Span]


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """The secrets of one layer: leftmost, non-overlapping within a kind."""
    lower = text.lower()
    if any(cue in lower for cue in CUES):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                yield "assign", *m.span()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", *m.span()
    for m in HEX.finditer(text):
        yield "hex", *m.span()


class Rewritten:
    """A layer made by decoding escapes in place.

    ``decoded`` holds ``(start, end, from, to, step)``: characters of the new
    layer, characters of the old one, and how many old ones each new one stands
    for (0: the whole run stands for the whole run).
    """

    def __init__(self, text: str, escapes: list[tuple[int, int, str, int]]):
        parts, at, length = [], 0, 0
        self.decoded: list[tuple[int, int, int, int, int]] = []
        for start, end, plain, step in escapes:
            parts += [text[at:start], plain]
            length += start - at
            self.decoded.append((length, length + len(plain), start, end, step))
            length, at = length + len(plain), end
        self.text = "".join([*parts, text[at:]])
        self.starts = [d[0] for d in self.decoded]

    def touches(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, end - 1) - 1
        return i >= 0 and self.decoded[i][1] > start

    def position(self, p: int, end: bool) -> int:
        """Where character ``p`` of the new layer begins, or ends, in the old one."""
        i = bisect_right(self.starts, p) - 1
        while i >= 0 and self.decoded[i][0] == self.decoded[i][1]:
            i -= 1  # an escape of nothing
        if i < 0:
            return p + end
        start, stop, a, b, step = self.decoded[i]
        if p >= stop:
            last = self.decoded[bisect_right(self.starts, p) - 1]
            return last[3] + (p - last[1]) + end
        if step:
            return a + (p - start + end) * step
        return b if end else a

    def up(self, start: int, end: int) -> Span:
        return self.position(start, False), self.position(end - 1, True)


def url_escapes(text: str) -> list[tuple[int, int, str, int]]:
    out = []
    for m in URL.finditer(text):
        plain = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace")
        out.append((*m.span(), plain, 3 if len(plain) * 3 == len(m[0]) else 0))
    return out


def unicode_escapes(text: str) -> list[tuple[int, int, str, int]]:
    out = []
    for m in UNICODE.finditer(text):
        code = int(m[6]) if m[6] else int(next(g for g in m.groups()[:5] if g), 16)
        if code <= 0x10FFFF:
            out.append((*m.span(), chr(code), 0))
    return out


def stream(data: bytes):
    """Pieces of the content of the compressed stream at the start of ``data``.

    Returns whether it came to its end, and what stands after it; (None, data) if no stream starts here.
    """
    if data[:4] == b"\x28\xb5\x2f\xfd":
        d, at = zstandard.ZstdDecompressor().decompressobj(), 0
        while at < len(data) and not d.eof:
            yield d.decompress(data[at : at + 256])
            at += 256
        return d.eof, d.unused_data + data[at:]
    if data[:3] == b"BZh" or data[:6] == b"\xfd7zXZ\0":
        d = bz2.BZ2Decompressor() if data[:1] == b"B" else lzma.LZMADecompressor()
        yield d.decompress(data, PIECE)
        while not d.eof and not d.needs_input:
            yield d.decompress(b"", PIECE)
        return d.eof, d.unused_data
    gzip = data[:2] == b"\x1f\x8b"
    if gzip or data[:1] == b"\x78" and len(data) > 2 and (data[0] << 8 | data[1]) % 31 == 0:
        d, out, left = zlib.decompressobj(31 if gzip else 15), b"", data
        while not d.eof and (out or left):
            out = d.decompress(left, PIECE)
            left = d.unconsumed_tail
            yield out
        return d.eof, d.unused_data
    return None, data


def streams(data: bytes):
    """Pieces of the content of all streams in ``data``, and what stands after the last one.

    Returns whether all came to their end; None if ``data`` are not compressed.
    """
    whole = None
    while data:
        some = False
        try:
            pieces = stream(data)
            while True:
                piece = next(pieces)
                some = some or bool(piece)
                yield piece
        except StopIteration as e:
            ended, rest = e.value
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
            if not some and whole:
                yield data
            return False if some or whole else None
        if ended is None:
            if whole:
                yield data
            return whole
        if not ended:
            return False
        whole, data = True, rest.lstrip(b"\0")
    return whole


def inflate(data: bytes) -> tuple[bytes | Iterator[bytes] | None, bool]:
    """The content of compressed data (None if they aren't), and whether it is whole and not over ``LAYER_BYTES``.

    A larger content comes as windows that overlap.
    """
    found, size, pieces = [], 0, streams(data)
    try:
        while size <= LAYER_BYTES:
            found.append(next(pieces))
            size += len(found[-1])
    except StopIteration as e:
        return (None if e.value is None else b"".join(found)), bool(e.value)
    return windows(chain(found, pieces)), False


def windows(pieces: Iterable[bytes]) -> Iterator[bytes]:
    held, size, last = [], 0, None
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= WINDOW:
            data = b"".join(held)
            if data != last:  # long runs of one character are read once
                yield data
            last, held = data, [data[-OVERLAP:]]
            size = OVERLAP
    yield b"".join(held)


def plain(data: bytes) -> str | None:
    """The text that ``data`` are, if they are UTF-8 without control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return None if CONTROL.search(text) else text


def readings(data: bytes) -> Iterator[tuple[str, Callable[[int], int]]]:
    """The texts that ``data`` may hold, each with a function from its characters to bytes of ``data``."""
    if (text := plain(data)) is not None:
        yield text, lambda i: len(text[:i].encode())
        return
    try:
        some = data.decode()
        yield some, lambda i: len(some[:i].encode())
    except UnicodeDecodeError:
        yield data.decode("latin-1"), lambda i: i
    at: dict[int, int] = {}  # where characters of 16 bits begin, on even and odd bytes
    for m in WIDE.finditer(data):
        at.setdefault(m.start() & 1, m.start())
        if len(at) == 2:
            break
    for odd, i in at.items():
        code, skip = ("utf-16-be", 1 - odd) if i and data[i - 1] == 0 else ("utf-16-le", odd)
        half = b"\0" * (len(data) - skip & 1)
        wide = (data[skip:] + half).decode(code, "replace")
        yield wide, lambda i, wide=wide, skip=skip: min(len(data), skip + len(wide[:i].encode("utf-16-le")))


def texts(content: bytes | Iterator[bytes]) -> Iterator[str]:
    """The layers that the content of a compressed part makes."""
    if isinstance(content, bytes):
        if inflate(content)[0] is not None:  # compressed twice: one more layer, as a base64 run
            yield base64.b64encode(content).decode()
            return
        content = iter([content])
    for data in content:
        for text, _ in readings(data):
            yield text


def base64_bytes(run: str) -> bytes | None:
    body = run.rstrip("=")
    body = body[: len(body) - (len(body) % 4 == 1)]  # six bits are no byte
    body = body.replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except binascii.Error:
        return None


class Run:
    """A base64 run, in one piece or several, the spans of which are given."""

    def __init__(self, text: str, pieces: list[Span]):
        self.pieces = pieces
        self.text = "".join(text[a:b] for a, b in pieces)
        self.span = pieces[0][0], pieces[-1][1]
        self.starts = [0]
        for a, b in pieces[:-1]:
            self.starts.append(self.starts[-1] + b - a)

    def position(self, p: int) -> int:
        i = bisect_right(self.starts, p) - 1
        return self.pieces[i][0] + p - self.starts[i]

    def up(self, first: int, last: int) -> Span:
        """Where bytes ``first`` to ``last`` of the decoded data stand."""
        return self.position(first * 4 // 3), self.position(min(len(self.text), -(-last * 4 // 3)) - 1) + 1


def one_stream(run: str) -> bool:
    """Whether a run is one compressed stream, from the first byte to the last."""
    pieces = stream(base64_bytes(run) or b"")
    try:
        while True:
            next(pieces)
    except StopIteration as e:
        return bool(e.value[0]) and not e.value[1]
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
        return False


def line_groups(text: str) -> Iterator[list[Span]]:
    """Lines that touch and hold nothing but a run, the first and last one aside; a line that is one stream is no part."""
    for m in WRAPPED.finditer(text):
        group, known = [], {}
        for x in LINE.finditer(text, *m.span()):
            if x[0] not in known:
                known[x[0]] = len(x[0]) >= 16 and one_stream(x[0])
            if known[x[0]]:
                yield group
                group = []
            else:
                group.append(x.span())
        yield group


def wrapped_runs(text: str) -> Iterator[Run]:
    """Runs over line breaks: blocks of lines of one width with the shorter one after them, then all lines that touch."""
    for lines in line_groups(text):
        widths = [b - a for a, b in lines]
        if len(lines) < 2 or sum(widths) < 16:
            continue
        blocks, at = [], 0
        while at < len(lines):
            end = at + 1
            while end < len(lines) and widths[end] == widths[at]:
                end += 1
            last = end + (end < len(lines) and widths[end] < widths[at])
            if last - at > 1 and last - at < len(lines) and sum(widths[at:last]) >= 16:
                blocks.append(lines[at:last])
            at = end
        for block in [*blocks, lines]:
            yield Run(text, block)


def inner_layers(
    text: str,
) -> Iterator[tuple[str, str | Iterator[str] | None, Up, Callable[[int, int], bool] | None, tuple[str, Span, int] | None]]:
    """The layers one step inside: ``(name, text, mapping of spans, which spans are new, part)``.

    ``part``: the compressed part to which all spans inside are mapped, as its characters,
    its span, and 1 if it was not opened to its end. Such a part has several texts, or None
    if it was met before.
    """
    for name, found in (
        ("url", url_escapes(text) if "%" in text else ()),
        ("unicode", unicode_escapes(text) if "\\" in text or "&#" in text else ()),
    ):
        if found:
            layer = Rewritten(text, found)
            yield name, layer.text, layer.up, layer.touches, None
    met: dict[str, bool] = {}  # compressed runs, the content of which is known, and whether they are whole
    whole: dict[int, int] = {}  # spans over line breaks that were unpacked to their end
    short = set()  # where other runs start
    lines = (Run(text, [m.span()]) for m in BASE64.finditer(text))
    ends: list[Span] = []
    for run in chain(wrapped_runs(text), lines):
        (a, b), inside = run.span, None
        data = None if run.text in met else base64_bytes(run.text)
        if data:
            packed, ended = inflate(data)
            text_only = plain(data) is not None and not ended and not isinstance(packed, Iterator)
            if packed is None or not ended and isinstance(packed, bytes):  # no compressed data, or they only start like some
                for read, byte in readings(data):
                    yield "base64", read, lambda s, e, run=run, byte=byte: run.up(byte(s), byte(e)), None, None
            if packed is None or text_only:
                continue
            inside = texts(packed)
            met[run.text] = ended
        elif run.text not in met:
            continue
        closed = 0
        if met[run.text]:
            if len(run.pieces) > 1:
                whole[a] = max(b, whole.get(a, 0))
        elif len(run.pieces) > 1:
            closed = int(a not in whole and a not in short)
            short.add(a)
        else:  # a line of data that were unpacked over line breaks is no loss
            if len(ends) < len(whole):
                for start in sorted(whole):
                    ends.append((start, max(whole[start], ends[-1][1] if ends else 0)))
            i = bisect_right(ends, (a, len(text))) - 1
            closed = int(a not in short and not (i >= 0 and ends[i][1] >= b))
        yield "base64>compressed", inside, lambda s, e, a=a, b=b: (a, b), None, (run.text, (a, b), closed)


def mapped(start: int, end: int, path: tuple[Up, ...]) -> Span:
    for up in path:
        start, end = up(start, end)
    return start, end


def find(text: str | None) -> tuple[list[tuple[str, int, int, str]], int]:
    """All spans ``(kind, start, end, layers)`` by start, kind and end, and the number of layers left closed.

    ``layers`` is empty for spans of the text itself.
    """
    if not text:
        return [], 0
    spans: dict[tuple[str, int, int], str] = {}
    # Of each compressed part: kinds and layers inside, how many of these were left closed, and
    # where the part stands, with 1 if it was itself left closed there.
    inside_of: dict[str, dict[str, str]] = {}
    closed_in: dict[str, int] = {}
    places: dict[str, dict[tuple[int, int, str], int]] = {}
    # The layer, or an iterator of layers, its name, the way up, which spans are new, and the compressed part it is in.
    work: list[tuple[str | Iterator[str], str, tuple[Up, ...], Callable | None, str | None]] = [(text, "", (), None, None)]
    seen: set[tuple] = set()

    def unseen(place: str | Span, layer: str) -> bool:
        """Whether a layer is new in its place, a span of the original or a compressed part."""
        met = (place, layer if len(layer) < 64 else hashlib.blake2b(layer.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        new = met not in seen
        seen.add(met)
        return new

    unseen((0, len(text)), text)
    while work:
        layer, name, path, new, part = work.pop()
        if not isinstance(layer, str):  # one text at a time, and what is in it
            rest, layer = layer, next(layer, None)
            if layer is None:
                continue
            work.append((rest, name, path, new, part))
            if not layer or not unseen(part, layer):
                continue
        for kind, start, end in scan(layer):
            if part is not None:
                inside_of[part].setdefault(kind, name)
            elif not new or new(start, end):
                spans.setdefault((kind, *mapped(start, end, path)), name)
        for step, inside, up, touches, run in inner_layers(layer):
            below, way = f"{name}>{step}" if name else step, (up, *path)
            if run:
                key, span, n = run
                if part is not None:
                    closed_in[part] += n
                    if inside is not None:
                        work.append((inside, below, (), None, part))
                    continue
                if key not in places:
                    places[key], inside_of[key], closed_in[key] = {}, {}, 0
                    if inside is not None:
                        work.append((inside, "", (), None, key))
                places[key][(*mapped(*span, path), below)] = n
            elif not inside:
                continue
            elif part is not None:
                if unseen(part, inside):
                    work.append((inside, below, (), None, part))
            elif unseen(mapped(0, len(inside), way), inside):
                work.append((inside, below, way, touches, None))
    for key, kinds in inside_of.items():
        for start, end, outer in places[key]:
            for kind, inner in kinds.items():
                spans.setdefault((kind, start, end), f"{outer}>{inner}" if inner else outer)
    closed = sum(n + closed_in[key] for key, found in places.items() for n in found.values())
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [(*s, spans[s]) for s in order], closed


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, spans, unopened)`` for every row of ``df``; see ``find``."""

    def start():
        def apply(keys, texts):
            found = [find(t) for t in texts]
            names = ("kind", "start", "end", "layers")
            return keys, [[dict(zip(names, s)) for s in spans] for spans, _ in found], [n for _, n in found]

        return apply

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df.select(id_col, text_col), start, f"`{id_col}` {kind}, spans {SPANS}, unopened int")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
