"""Secret scans through nested encodings.

A text is the first layer of a worklist. Every layer is scanned, then unwrapped: escapes of
URLs (``%41``) and of Unicode (``\\u0041``, ``\\x41``, ``\\u{41}``) are resolved in place,
runs of base64, also over several lines, are decoded, and decoded bytes, also of percent
escapes, that are compressed (gzip, zlib, bzip2, xz,
zstandard) are expanded. New layers join the list until none is left. A layer whose text
and origin were seen before is not entered again, so an encoding that yields itself ends.

Each layer knows, per character, the span of the original text it came from; what is found
in a layer is reported at that span.

Defined cases: a null or empty text has no span and one layer; repeated rows get the same
answer. Expansion of compressed data stops at ``EXPANDED_BYTES`` per run, a guard against
archives made to exhaust memory; the text before that point is scanned.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote_to_bytes

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import per_text

#: The kinds in the order that spans with equal starts are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of hex digits that are long enough
MIN_VALUE, MIN_ACCESS = 8, 16

ESCAPE = re.compile(
    r"(?:%[0-9A-Fa-f]{2})+"
    r"|(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+"
)
UNIT = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 over several lines, as MIME, PEM and the base64 tool write it.
#: A run is entered at its first character only and never given back: one pass over a text.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
BREAKS = re.compile(r"\s+")
#: Bytes written as percent escapes and unreserved characters; compressed data may begin
#: with one of the latter.
PERCENT = re.compile(r"(?:x|BZh[1-9]1AY)?(?:%[0-9A-Fa-f]{2}[A-Za-z0-9_.~/*!'()+-]*)+")
URL_SAFE = str.maketrans("-_", "+/")
#: The shortest secret has 14 characters, the shortest run of base64 16.
READABLE = re.compile(rb"[\t\n\r\x20-\x7e]{14}")
EXPANDED_BYTES = 64 << 20
#: Compressed bytes handed to a decoder at once.
FED_BYTES = 1 << 16

Span = tuple[int, int]


@dataclass
class Layer:
    text: str
    #: Original (start, past) of each character; None: the text is the original; one span:
    #: every character stands for it.
    origin: list[Span] | Span | None

    def span(self, start: int, past: int) -> Span:
        if self.origin is None:
            return start, past
        if isinstance(self.origin, tuple):
            return self.origin
        return self.origin[start][0], self.origin[past - 1][1]


def secrets_in(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, past, kind) of each match, kind as a place in KINDS."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_VALUE:
                yield m.start(), m.end(), 0
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= MIN_ACCESS:
                yield m.start(), m.end(), 1
    for m in HEX.finditer(text):
        yield m.start(), m.end(), 2


def _units(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of backslash escapes with their place in it."""
    out: list[tuple[str, int, int]] = []
    for m in UNIT.finditer(run):
        code = int(m[1] or m[2], 16)
        if 0xDC00 <= code < 0xE000 and out and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, start, _ = out.pop()
            code = 0x10000 + ((ord(high) - 0xD800) << 10) + (code - 0xDC00)
            out.append((chr(code), start, m.end()))
        else:
            out.append((chr(code) if code < 0x110000 else "\ufffd", m.start(), m.end()))
    return [("\ufffd" if 0xD800 <= ord(c) < 0xE000 else c, a, b) for c, a, b in out]


def _percent(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of percent escapes; bytes that are no UTF-8 stand for themselves."""
    raw, out, at = bytes.fromhex(run.replace("%", "")), [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                char = raw[at : at + size].decode()
            except UnicodeDecodeError:
                continue
            break
        else:
            size, char = 1, chr(raw[at])
        out.append((char, 3 * at, 3 * min(at + size, len(raw))))
        at += size
    return out


def unescape(layer: Layer) -> Layer | None:
    """The layer with its escapes resolved, if it has any."""
    text = layer.text
    if "%" not in text and "\\" not in text:
        return None
    chars: list[str] = []
    origin: list[Span] = []
    at = 0
    for m in ESCAPE.finditer(text):
        chars.append(text[at : m.start()])
        origin += [layer.span(i, i + 1) for i in range(at, m.start())]
        units = _percent(m[0]) if m[0][0] == "%" else _units(m[0])
        chars += [c for c, _, _ in units]
        origin += [layer.span(m.start() + a, m.start() + b) for _, a, b in units]
        at = m.end()
    if not at:
        return None
    chars.append(text[at:])
    origin += [layer.span(i, i + 1) for i in range(at, len(text))]
    return Layer("".join(chars), layer.origin if isinstance(layer.origin, tuple) else origin)


#: From bytes to what they expand to; notes where members after the first begin.
Decoder = Callable[[memoryview, list[int]], bytes]


def _members(new: Callable) -> Decoder:
    """Expansion of one or more compressed members, one behind the other; what comes before
    damage or the end of cut data is kept. Data is fed in parts, so that what follows a member
    is never copied as a whole."""

    def decode(raw: memoryview, starts: list[int]) -> bytes:
        out, size, at, member = [], 0, 0, new()
        while at < len(raw) and size < EXPANDED_BYTES:
            part = raw[at : at + FED_BYTES]
            try:
                while True:
                    out.append(member.decompress(part, EXPANDED_BYTES - size))
                    size += len(out[-1])
                    # What a limit on the output held back comes first.
                    part = getattr(member, "unconsumed_tail", b"")
                    if not part or member.eof or size >= EXPANDED_BYTES:
                        break
            except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
                break
            at += FED_BYTES
            if member.eof:
                at = min(at, len(raw)) - len(member.unused_data)
                starts.append(at)
                member = new()
        return b"".join(out)

    return decode


def _zlib(bits: int) -> Decoder:
    return _members(lambda: zlib.decompressobj(bits))


def _zstd(raw: memoryview, starts: list[int]) -> bytes:
    out, size, at, whole = [], 0, 0, b""
    while at >= 0 and size < EXPANDED_BYTES:
        # One frame; the next begins at the next magic number that can be read.
        with zstandard.ZstdDecompressor().stream_reader(raw[at:]) as reader:
            try:
                while part := reader.read(min(1 << 16, EXPANDED_BYTES - size)):
                    out.append(part)
                    size += len(part)
            except zstandard.ZstdError:
                pass
        if not size:
            break
        whole = whole or bytes(raw)
        at = whole.find(b"\x28\xb5\x2f\xfd", at + 4)
        starts.append(at)
    return b"".join(out)


#: First bytes of compressed data.
FORMATS: tuple[tuple[bytes, Decoder], ...] = (
    (b"\x1f\x8b", _zlib(31)),
    (b"\x78\x01", _zlib(15)),
    (b"\x78\x5e", _zlib(15)),
    (b"\x78\x9c", _zlib(15)),
    (b"\x78\xda", _zlib(15)),
    (b"BZh", _members(bz2.BZ2Decompressor)),
    (b"\xfd7zXZ\x00", _members(lzma.LZMADecompressor)),
    (b"\x28\xb5\x2f\xfd", _zstd),
)


def expand(raw: bytes) -> Iterator[bytes]:
    """The data and each layer of compression below it, until none or one seen before."""
    seen = set()
    while raw not in seen:
        seen.add(raw)
        yield raw
        decode = next((d for magic, d in FORMATS if raw.startswith(magic)), None)
        if decode is None:
            return
        raw = decode(memoryview(raw), [])


def _as_text(raw: bytes) -> str | None:
    """Bytes as text, whatever they hold besides, if a secret or a run to decode has room in it."""
    return raw.decode(errors="replace") if READABLE.search(raw) else None


def _data(raw: bytes) -> Iterator[bytes]:
    """The data and what is compressed in it, from whatever place on. Members read behind
    another are not read again from their own place."""
    yield raw
    view = memoryview(raw)
    for magic, decode in FORMATS:
        at, read = raw.find(magic), set()
        while at >= 0:
            if at not in read:
                starts: list[int] = []
                if inside := decode(view[at:], starts):
                    yield from expand(inside)
                read.update(at + start for start in starts)
            at = raw.find(magic, at + 1)


def _raw_runs(text: str) -> Iterator[tuple[Span, bytes]]:
    """Bytes that runs of a text may stand for. What precedes a run of base64 in its
    characters (a path, a word) shifts it, so each is read at all four alignments."""
    runs = [(m.span(), m[0]) for m in BASE64.finditer(text)]
    runs += [(m.span(), BREAKS.sub("", m[0])) for m in WRAPPED.finditer(text)]
    for span, run in runs:
        run = run.rstrip("=").translate(URL_SAFE)
        for shift in range(4):
            own = run[shift:]
            if len(own) % 4 == 1:
                own = own[:-1]
            yield span, base64.b64decode(own + "=" * (-len(own) % 4))
    if "%" in text:
        for m in PERCENT.finditer(text):
            yield m.span(), unquote_to_bytes(m[0])
            if "+" in m[0]:
                yield m.span(), unquote_to_bytes(m[0].replace("+", " "))


def decoded_runs(layer: Layer) -> Iterator[Layer]:
    """Layers below the runs of base64 and of percent escapes of a layer."""
    for span, raw in _raw_runs(layer.text):
        for data in _data(raw):
            text = _as_text(data)
            if text is not None:
                yield Layer(text, layer.span(*span))


def find(text: str | None) -> tuple[list[tuple[int, int, int, int]], int]:
    """Spans as (start, past, kind, layer), layer 0 for the text itself and 1 for deeper
    ones, ascending by start and kind; the number of layers entered."""
    spans: set[tuple[int, int, int, int]] = set()
    work, seen, entered = [Layer(text or "", None)], set(), 0
    while work:
        layer = work.pop()
        key = (layer.text, layer.origin if isinstance(layer.origin, tuple) else None)
        if key in seen:
            continue
        seen.add(key)
        entered += 1
        deep = int(layer.origin is not None)
        for start, past, kind in secrets_in(layer.text):
            first, end = layer.span(start, past)
            if not deep or (first, end, kind, 0) not in spans:
                spans.add((first, end, kind, deep))
        if plain := unescape(layer):
            work.append(plain)
        work += decoded_runs(layer)
    return sorted(spans, key=lambda s: (s[0], s[2], s[1], s[3])), entered


SPANS = "spans array<struct<kind:string,first:int,past:int,layer:int>>, n_layers int"


def _finder():
    def one(text: str | None) -> tuple:
        spans, layers = find(text)
        return [(KINDS[kind], first, past, layer) for first, past, kind, layer in spans], layers

    return one


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep``, the spans of every secret and the number of layers read."""
    found = docs.select(*keep, per_text(_finder, SPANS)(F.col(text)).alias("found"))
    return found.select(*keep, "found.*")
