"""Secret scan with a worklist of decoded layers.

A text is layer zero. Every layer is searched for the three kinds of secrets and for encoded parts:
URL escapes and Unicode escapes are undone over the whole layer, base64 runs (and what they hold in
compressed form, all members of it) become layers of their own, of one line and, where lines of one
length follow each other, of all of them. A run may be glued to other characters of its alphabet, so it is
decoded from each of its first four characters on, and packed data are looked for everywhere in it. Bytes that are no UTF-8 are read as UTF-16 or Latin-1. New layers join the worklist until none is left; a
layer whose text was already searched at the same place is not searched again, so cycles end. Each
layer remembers from which characters of the text its characters come, so a secret found at any
depth is reported as a span of the text.
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
from collections import deque
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.common import map_batches, text_column

# fixed values: the kinds in their order of report, and their patterns
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE = 12

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"(?:\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2})"
    r"|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}"
)
PIECE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# stretches of text among bytes that are none, one or two bytes to a character
STRETCH = re.compile(rb"[\t\r\n\x20-\x7e]{12,}|(?:[\t\r\n\x20-\x7e]\0){12,}")
# fixed values: how gzip, bzip2, xz and zlib data begin in base64
PACKED = re.compile(r"H4sI|Qlpo|[/_]Td6WFoA|eAE|eF[4-7]|eJ[w-z]|eN[o-r]")
URL_SAFE = str.maketrans("-_", "+/")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the secrets that stand in the text itself, in order."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A text and the span of the document behind each character; ``starts`` None: all behind one span."""

    __slots__ = ("text", "starts", "ends", "depth")

    def __init__(self, text, starts, ends, depth):
        self.text, self.starts, self.ends, self.depth = text, starts, ends, depth

    def span(self, low: int, high: int) -> tuple[int, int]:
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return self.starts[low], self.ends[high - 1]


def _unescape_url(match: re.Match) -> str | None:
    raw = bytes.fromhex(match[0].replace("%", ""))
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _unescape_unicode(match: re.Match) -> str | None:
    part = match[0]
    if part.startswith("&"):
        code = int(part[3:-1], 16) if part[2] in "xX" else int(part[2:-1])
    elif len(part) == 12 and part[1] == "u":
        high, low = int(part[2:6], 16), int(part[8:], 16)
        code = 0x10000 + ((high - 0xD800) << 10) + (low - 0xDC00)
    else:
        code = int(part[2:], 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match decoded; characters of a decoded match stand for the whole match."""
    parts, starts, ends, at = [], [], [], 0
    flat = isinstance(layer.starts, int)
    for match in pattern.finditer(layer.text):
        new = decode(match)
        if new is None:
            continue
        low, high = match.span()
        parts += (layer.text[at:low], new)
        if not flat:
            first, last = layer.span(low, high)
            starts += layer.starts[at:low]
            ends += layer.ends[at:low]
            starts += [first] * len(new)
            ends += [last] * len(new)
        at = high
    if not parts:
        return None
    parts.append(layer.text[at:])
    if flat:
        return Layer("".join(parts), layer.starts, layer.ends, layer.depth + 1)
    return Layer("".join(parts), starts + list(layer.starts[at:]), ends + list(layer.ends[at:]), layer.depth + 1)


def _unpacked(data: bytes) -> bytes | None:
    """The content of all members of gzip, zlib, bzip2 or xz data and what follows them, else nothing.

    A truncated stream yields what it holds.
    """
    parts = []
    while data:
        try:
            if data[:2] == b"\x1f\x8b":
                reader = zlib.decompressobj(31)
            elif data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
                reader = zlib.decompressobj()
            elif data[:3] == b"BZh":
                reader = bz2.BZ2Decompressor()
            elif data[:6] == b"\xfd7zXZ\x00":
                reader = lzma.LZMADecompressor()
            else:
                break
            content = reader.decompress(data)
        except (zlib.error, OSError, lzma.LZMAError, EOFError):
            break
        parts.append(content)
        data = reader.unused_data.lstrip(b"\0")  # members may be padded
    return b"".join([*parts, data]) if parts else None


def _readable(data: bytes) -> tuple[str, str]:
    """The text of bytes and its encoding: UTF-8, else UTF-16 where marked or every other byte is zero, else Latin-1."""
    zeros = data.count(0) * 3 > len(data)
    encodings = ["utf-8", "latin-1"]
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        encodings = ["utf-16", "latin-1"]
    elif zeros:
        encodings = ["utf-16-le" if data[1::2].count(0) > data[::2].count(0) else "utf-16-be", "latin-1"]
    for encoding in encodings:
        try:
            return data[: len(data) // 2 * 2 if encoding.startswith("utf-16") else None].decode(encoding), encoding
        except UnicodeDecodeError:
            pass
    raise AssertionError("every byte is Latin-1")


def _from_base64(run: str) -> tuple[bytes, bool] | None:
    """The bytes of a run, unpacked, and whether they were packed."""
    body = run.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body.translate(URL_SAFE) + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None
    packed = False
    for _ in range(len(data)):
        inner = _unpacked(data)
        if inner is None:
            break
        data, packed = inner, True
    return data, packed


def _glued(run: str, whole: bytes):
    """``text, low, high`` of what a run holds beside characters that do not belong to it, and is not in ``whole``.

    Decoding from another character on gives bytes that are no text before and after the right ones; the
    stretches of text are kept, each with the characters that it comes from. Packed data are
    tried wherever one can begin; what follows them is ignored.
    """
    body = run.rstrip("=")
    for lead in range(4):
        if not lead and len(body) % 4 != 1:
            continue  # the whole run is a layer anyway
        part = body[lead : len(body) - ((len(body) - lead) % 4 == 1)].translate(URL_SAFE)
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        for match in STRETCH.finditer(data):
            text = match[0].replace(b"\0", b"").decode("ascii")
            yield text, lead + match.start() * 8 // 6, lead + -(-match.end() * 8 // 6)
    seen = [whole]
    for match in PACKED.finditer(body, 1):
        part = body[match.start() :]
        content = _from_base64(part[: len(part) - (len(part) % 4 == 1)])
        if content and content[1] and content[0] and not any(content[0] in data for data in seen):
            seen.append(content[0])
            yield _readable(content[0])[0], match.start(), len(run)


def _wrapped(text: str):
    """The pieces, as spans, of what may be one base64 run wrapped into lines.

    Lines of one length belong together, with a shorter one after them and the end of a line before them.
    """
    for chain in WRAPPED.finditer(text):
        pieces = [m.span() for m in PIECE.finditer(text, *chain.span())]
        sizes = [high - low for low, high in pieces]
        first = 0
        while first < len(pieces):
            last = first + 1
            while last < len(pieces) and sizes[last] == sizes[first]:
                last += 1
            lasts = [last, last + 1] if last < len(pieces) and sizes[last] < sizes[first] else [last]
            for low in (first, first - 1) if first else (first,):
                yield from (pieces[low:high] for high in lasts if high - low > 1)
            first = last


def _joined_layer(layer: Layer, pieces: list[tuple[int, int]]) -> Layer | None:
    """The layer that wrapped pieces hold; a character stands for the pieces that it comes from, packed ones for all."""
    content = _from_base64("".join(layer.text[low:high] for low, high in pieces))
    if content is None or not content[0]:
        return None
    text, encoding = _readable(content[0])
    spans = [(low, high) if layer.starts is None else layer.span(low, high) for low, high in pieces]
    if content[1] or isinstance(layer.starts, int):
        return Layer(text, spans[0][0], spans[-1][1], layer.depth + 1)
    ends = list(accumulate(high - low for low, high in pieces))
    at, starts, stops = 2 if encoding == "utf-16" else 0, [], []
    encoding = "utf-16-le" if encoding == "utf-16" else encoding
    for character in text:
        size = 1 if character.isascii() and encoding in ("utf-8", "latin-1") else len(character.encode(encoding))
        starts.append(spans[min(bisect_right(ends, at * 8 // 6), len(spans) - 1)][0])
        at += size
        stops.append(spans[min(bisect_right(ends, (at * 8 - 1) // 6), len(spans) - 1)][1])
    return Layer(text, starts, stops, layer.depth + 1)


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and those together with all that decoded layers add."""
    base = base_spans(text)
    found = set(base)
    work = deque(_next_layers(Layer(text, None, None, 0)))
    seen: set[tuple] = set()
    while work:
        layer = work.popleft()
        place = layer.span(0, len(layer.text)) if layer.text else None
        key = (hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest(), place)
        if place is None or key in seen:
            continue
        seen.add(key)
        for low, kind, high in base_spans(layer.text):
            first, last = layer.span(low, high)
            found.add((first, kind, last))
        work.extend(_next_layers(layer))
    return base, sorted(found)


def _next_layers(layer: Layer):
    text, top = layer.text, layer.starts is None
    url = "%" in text and URL.search(text)
    escaped = ("\\" in text or "&#" in text) and ESCAPE.search(text)
    if top and (url or escaped):
        layer = Layer(text, range(len(text)), range(1, len(text) + 1), 0)
    if url and (new := _replaced(layer, URL, _unescape_url)):
        yield new
    if escaped and (new := _replaced(layer, ESCAPE, _unescape_unicode)):
        yield new
    for match in BASE64.finditer(text):
        content = _from_base64(match[0])
        if content and content[0]:
            low, high = match.span() if layer.starts is None else layer.span(*match.span())
            yield Layer(_readable(content[0])[0], low, high, layer.depth + 1)
        for inner, first, last in _glued(match[0], content[0] if content else b""):
            place = match.start() + first, match.start() + last
            yield Layer(inner, *(place if layer.starts is None else layer.span(*place)), layer.depth + 1)
    for pieces in _wrapped(text):
        if new := _joined_layer(layer, pieces):
            yield new


def _joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, kind, start, end, in_text`` of every secret; ``in_text`` false: only a decoded layer shows it."""

    def find(batch: pa.RecordBatch):
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            base, spans = all_spans(text)
            own = set(base)
            rows += [(key, KINDS[s[1]], s[0], s[2], s in own) for s in spans]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "kind", "start", "end", "in_text"]
        )

    return map_batches(_source(docs), find, "doc_id bigint, kind string, start bigint, end bigint, in_text boolean")


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_column().alias("text"))


DIGEST = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def scan_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the secrets in the text itself, and all spans.

    Offsets count code points, ends are exclusive. A null text is empty and has no spans; null and
    repeated ``doc_id`` are kept row by row; further columns of ``docs`` are ignored; an empty table
    gives no rows. Whole texts are scanned, whatever their length.
    """

    def digest(batch: pa.RecordBatch):
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            base, spans = all_spans(text)
            counts = [sum(s[1] == k for s in base) for k in range(3)]
            rows.append((key, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
        kinds = (pa.int64(),) * 4 + (pa.string(),) * 2
        names = [field.split()[0] for field in DIGEST.split(", ")]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(_source(docs), digest, DIGEST)
