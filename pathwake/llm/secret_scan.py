"""Secrets in texts and in what texts encode, by a worklist of decoded layers.

The text is the first layer. In every layer the kinds are searched, and encoded stretches are
unwrapped to new layers: URL escapes, Unicode escapes, base64 at each of its four alignments
and, inside base64, gzip and zlib streams. Decoded bytes are read as UTF-8, else as Latin-1, and
as UTF-16 too if they hold a NUL; all patterns are ASCII, so nothing is lost by control
characters or other encodings. A layer seen before is not visited again, which ends cycles, for
unfolded streams too. Each character of a layer knows the stretch of the given text it comes
from, so a find in any layer has a span there.

The worklist goes depth first: besides the layers between the text and the one at work none is
held. Escapes of escapes are unwrapped level by level up to ``LEVELS``; what is nested deeper is
taken to its end at once, in one pass, so that time stays in proportion to the text.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the contract: kinds, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_VALUE = re.compile(r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_LEAST_VALUE, _LEAST_ACCESS = 8, 16

DECODED = tuple(f"decoded_{k}" for k in KINDS)
_SEPARATOR = re.compile("[:=]")
_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|&#x([0-9a-fA-F]{1,6});|&#([0-9]{1,7});")
_TAIL = re.compile(r"(?:%([0-9a-fA-F]{2})|\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|&#x([0-9a-fA-F]{1,6});|&#([0-9]{1,7});)\Z")
_CLOSERS = frozenset("0123456789abcdefABCDEF;")
_LONGEST = len("&#x10FFFF;")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_JOINT = re.compile("[/_-]")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++={0,2}(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++={0,2})++")
_LEAST_BASE64 = 16
_STEP = 4096
LEVELS = 4
# Unfolded streams of a text that are held at once; a stretch that needs more is left closed,
# and n_unopened counts them.
LAYER_BYTES = 64 << 20
LEAST_LAYER = len("token=") + _LEAST_VALUE

_SCANNED = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long, n_unopened long"
Find = tuple[int, int, str]  # start, end, kind
Piece = tuple[int, int, str, np.ndarray]  # start, end, text instead, bounds of its characters


def finds(text: str) -> Iterator[Find]:
    """Secrets of one layer; matches of a kind are leftmost and do not overlap."""
    last = 0
    for sign in _SEPARATOR.finditer(text):
        at = sign.start()
        if at < last:
            continue
        end = at
        while end > last and text[end - 1] == " ":
            end -= 1
        if end > last and text[end - 1] in "\"'":
            end -= 1
        head = text[max(last, end - 8):end]
        head = head.lower() if head.isascii() else "".join(c.lower() if c.isascii() else "?" for c in head)
        keyword = next((k for k in _KEYWORDS if head.endswith(k)), None)
        value = _VALUE.match(text, at) if keyword else None
        if value:
            last = value.end()
            if len(value.group(1)) >= _LEAST_VALUE:
                yield end - len(keyword), last, "assign"
    if "AKIA" in text:
        for found in _ACCESS.finditer(text):
            if found.end() - found.start() >= _LEAST_ACCESS:
                yield *found.span(), "access"
    for found in _HEX.finditer(text):
        yield *found.span(), "hex"


class Layer:
    """A text whose character ``i`` comes from ``begins[i]:ends[i]`` of the given text."""

    def __init__(self, text: str, begins: np.ndarray | None = None, ends: np.ndarray | None = None, level: int = 0, size: int = 0):
        self.text, self.begins, self.ends = text, begins, ends
        self.level, self.size = level, size  # of escapes; bytes unfolded for it

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.begins is None:
            return start, end
        return int(self.begins[start:end].min()), int(self.ends[start:end].max())

    def replaced(self, pieces: Iterator[Piece]) -> Layer | None:
        """The whole text with stretches replaced; None without any."""
        kept, begins, ends, done = [], [], [], 0
        one = self.begins is not None and self.begins.strides == (0,)  # all of one stretch
        for start, end, text, edges in pieces:
            kept += [self.text[done:start], text]
            if not one:
                begins += [np.arange(done, start), edges[:-1]]
                ends += [np.arange(done + 1, start + 1), edges[1:]]
            done = end
        if not kept:
            return None
        if one:
            text = "".join(kept) + self.text[done:]
            return Layer(text, np.broadcast_to(self.begins[0], len(text)), np.broadcast_to(self.ends[0], len(text)), self.level + 1)
        rest = np.arange(done, len(self.text))
        begin = np.concatenate([*begins, rest]).astype(np.int64)
        end = np.concatenate([*ends, rest + 1]).astype(np.int64)
        # Bounds never fall along a layer, so those of a stretch are those of its edges.
        if self.begins is not None:
            begin, end = self.begins[begin], self.ends[end - 1]
        return Layer("".join(kept) + self.text[done:], begin, end, self.level + 1)

    def whole(self, text: str, start: int, end: int, size: int) -> Layer:
        """A layer of which every character comes from the same stretch."""
        a, b = self.span(start, end)
        return Layer(text, np.broadcast_to(np.int64(a), len(text)), np.broadcast_to(np.int64(b), len(text)), 0, size)


def _url_pieces(text: str) -> Iterator[Piece]:
    for found in _ESCAPES.finditer(text):
        data = bytes.fromhex(found.group().replace("%", ""))
        try:
            plain = data.decode("utf-8")
            sizes = [len(c.encode()) for c in plain]
        except UnicodeDecodeError:
            plain = data.decode("latin-1")
            sizes = [1] * len(plain)
        yield *found.span(), plain, found.start() + 3 * np.cumsum([0, *sizes])


def _url_layers(layer: Layer) -> Iterator[Layer]:
    if "%" in layer.text and layer.level < LEVELS and (plain := layer.replaced(_url_pieces(layer.text))):
        yield plain


def _unicode_pieces(text: str) -> Iterator[Piece]:
    for found in _UNICODE.finditer(text):
        digits = next(g for g in found.groups() if g is not None)
        code = int(digits, 10 if found.group(4) is not None else 16)
        if code <= 0x10FFFF and not 0xD800 <= code < 0xE000:
            yield *found.span(), chr(code), np.array(found.span())


def _unicode_layers(layer: Layer) -> Iterator[Layer]:
    if ("\\" in layer.text or "&#" in layer.text) and layer.level < LEVELS and (plain := layer.replaced(_unicode_pieces(layer.text))):
        yield plain


def _peeled_pieces(text: str) -> Iterator[Piece]:
    """Escapes of any depth as their last character, whatever nests in them; one pass.

    A character that completes an escape with those before it takes their place, and may
    complete the next. Bytes beyond ASCII stay as Latin-1, which no pattern looks at.
    """
    out, begins = [], []  # what stands so far, and where each of it begins
    changed: list[tuple[int, int, int]] = []  # place in out, begin, end
    for at, char in enumerate(text):
        begin = at
        while True:
            out.append(char)
            begins.append(begin)
            if char not in _CLOSERS or not (found := _TAIL.search("".join(out[-_LONGEST:]))):
                break
            digits, base = next((g, b) for g, b in zip(found.groups(), (16, 16, 16, 16, 10), strict=True) if g is not None)
            code = int(digits, base)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                break
            size = found.end() - found.start()
            begin, char = begins[-size], chr(code)
            del out[-size:], begins[-size:]
            while changed and changed[-1][0] >= len(out):
                changed.pop()
            changed.append((len(out), begin, at + 1))
    for place, begin, end in changed:
        yield begin, end, out[place], np.array([begin, end])


def _peeled_layers(layer: Layer) -> Iterator[Layer]:
    if layer.level == LEVELS and ("%" in layer.text or "\\" in layer.text or "&#" in layer.text):
        if plain := layer.replaced(_peeled_pieces(layer.text)):
            yield plain


def _readings(data: bytes) -> Iterator[str]:
    """The texts that bytes may stand for; those too short for a find, or a layer with one, are left out."""
    if len(data) < LEAST_LAYER:
        return
    try:
        yield data.decode("utf-8")
    except UnicodeDecodeError:
        yield data.decode("latin-1")
    if b"\0" in data:  # as in UTF-16 of any ASCII character
        for order in ("utf-16-le", "utf-16-be"):
            for part in (data, data[1:]):
                text = part[:len(part) // 2 * 2].decode(order, "replace")
                if len(text) >= LEAST_LAYER:
                    yield text


def _inflate(data: bytes, room: int) -> bytes | None:
    """The unfolded streams and what follows them, b"" if there is none, None if it needs more room."""
    out = []
    while _folded(data):
        if room <= 0:
            return None
        stream = zlib.decompressobj(zlib.MAX_WBITS | 32)
        try:
            out.append(stream.decompress(data, room))
        except zlib.error:
            break
        if stream.unconsumed_tail:
            return None
        room -= len(out[-1])
        data = stream.unused_data
    plain = b"".join(out)
    return plain + b"\n" + data if plain and data else plain


def _folded(data: bytes) -> bool:
    """Begins like a gzip or zlib stream."""
    return data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 1 and int.from_bytes(data[:2], "big") % 31 == 0


def _stretches(text: str) -> Iterator[tuple[int, int, str]]:
    """Base64 of one line and of lines broken at one width; the first and last line may be shorter.

    Lines of one width are taken with and without the line before them, which may be a word.
    """
    for found in _BASE64.finditer(text):
        yield *found.span(), found.group()
    for found in _LINES.finditer(text):
        lines = list(_LINE.finditer(text, *found.span()))
        width = [line.end() - line.start() for line in lines]
        closed = [line.group().endswith("=") for line in lines]
        at = 0
        while at < len(lines):
            to = at + 1
            while to < len(lines) and width[to] == width[at] and not closed[to - 1]:
                to += 1
            end = to + (to < len(lines) and width[to] < width[at] and not closed[to - 1])
            if width[at] >= _LEAST_BASE64:
                for start in (at, at - 1) if at and not closed[at - 1] else (at,):
                    if end - start > 1:
                        yield lines[start].start(), lines[end - 1].end(), "".join(line.group() for line in lines[start:end])
            at = to


def _decoded(code: str) -> bytes:
    """Bytes of base64 of any length; a last single character says nothing."""
    code = code[:len(code) - (len(code) % 4 == 1)]
    return base64.b64decode(code + "=" * (-len(code) % 4))


def _base64_readings(stretch: str) -> Iterator[bytes]:
    """What base64 gives at each alignment, and streams that begin behind ``/``, ``_`` or ``-``.

    A stretch may be glued to letters or to a path. Where it begins is not known, but only how
    it is aligned matters: letters in front become a few bytes before the content.
    """
    code = stretch.rstrip("=").replace("-", "+").replace("_", "/")
    for offset in range(min(4, len(code) - _LEAST_BASE64 + 1)):
        yield _decoded(code[offset:])
    done = 4  # streams that begin before it have been tried
    for found in _JOINT.finditer(stretch):
        at = found.end()
        if done <= at <= len(code) - _LEAST_BASE64 and _folded(_decoded(code[at:at + 4])):
            done, whole = _stream_end(code, at)
            if whole:
                yield _decoded(code[at:])


def _stream_end(code: str, at: int) -> tuple[int, bool]:
    """Up to where a compressed stream can be read from ``at``, and whether it has no error."""
    stream = zlib.decompressobj(zlib.MAX_WBITS | 32)
    while at < len(code) and not stream.eof:
        try:
            rest = _decoded(code[at:at + _STEP])
            while rest:
                stream.decompress(rest, LAYER_BYTES >> 10)
                rest = stream.unconsumed_tail
        except zlib.error:
            return at, False
        at += _STEP
    return at, True


def _base64_layers(layer: Layer, room: list[int], unopened: set[tuple[int, int]]) -> Iterator[Layer]:
    for start, end, stretch in _stretches(layer.text):
        for data in _base64_readings(stretch):
            # A stream may hold streams, and one of them itself.
            seen: set[bytes] = set()
            while data is not None and (digest := hashlib.sha256(data).digest()) not in seen:
                seen.add(digest)
                inner = _inflate(data, room[0])
                if inner is None:
                    unopened.add(layer.span(start, end))
                if not inner or len(seen) > 1:
                    size = len(data) if len(seen) > 1 else 0
                    for text in _readings(data):
                        yield layer.whole(text, start, end, size)
                data = inner or None


def _children(layer: Layer, room: list[int], unopened: set[tuple[int, int]]) -> Iterator[Layer]:
    yield from _url_layers(layer)
    yield from _unicode_layers(layer)
    yield from _peeled_layers(layer)
    yield from _base64_layers(layer, room, unopened)


def scan_text(text: str) -> tuple[list[Find], list[Find], int]:
    """``(base finds, finds of decoded layers, stretches left closed)``, each list in order."""
    base = sorted(finds(text), key=lambda f: (f[0], KINDS.index(f[2])))
    unopened: set[tuple[int, int]] = set()
    more: set[Find] = set()
    seen = {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}
    room = [LAYER_BYTES]
    work = [(_children(Layer(text), room, unopened), 0)]
    while work:
        found = next(work[-1][0], None)
        if found is None:
            room[0] += work.pop()[1]
            continue
        key = hashlib.sha256(found.text.encode("utf-8", "surrogatepass"))
        if found.begins is not None and len(found.text):
            # The same content at another place is another layer.
            key.update(f"{found.begins[0]}:{found.ends[-1]}".encode())  # bounds never fall
        if not found.text or key.digest() in seen:
            continue
        seen.add(key.digest())
        more.update((*found.span(a, b), f"decoded_{k}") for a, b, k in finds(found.text))
        room[0] -= found.size
        work.append((_children(found, room, unopened), found.size))
    # What the text shows openly is no decoded find.
    open_spans = {(a, b, f"decoded_{k}") for a, b, k in base}
    return base, sorted(more - open_spans, key=lambda f: (f[0], DECODED.index(f[2]), f[1])), len(unopened)


def listed(found: list[Find]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def _scan(texts: pa.Array) -> pa.Array:
    rows = []
    for value in texts:
        base, more, unopened = scan_text(value.as_py() or "")
        kinds = [k for _, _, k in base]
        order = KINDS + DECODED
        both = sorted(base + more, key=lambda f: (f[0], order.index(f[2]), f[1]))
        rows.append({
            **{f"n_{k}": kinds.count(k) for k in KINDS},
            "base_sha256": hashlib.sha256(listed(base).encode()).hexdigest(),
            "spans": listed(both), "n_decoded": len(more), "n_unopened": unopened,
        })
    return pa.array(rows, pa.struct([
        *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string()),
        ("n_decoded", pa.int64()), ("n_unopened", pa.int64()),
    ]))


def scan(text: Column) -> Column:
    """struct(n_assign, n_access, n_hex, base_sha256, spans, n_decoded, n_unopened) of a text column."""
    return F.arrow_udf(_scan, _SCANNED)(text.cast("string"))


def secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and the columns of :func:`scan`.

    Spans are kind:start:end in code points of the given text, by start and then kind.

    Defined for every input: null reads as empty and has no spans; repeated rows give equal
    rows; an empty table gives an empty result; columns other than doc_id and text are not read.
    A text of any length is searched whole; besides it a task holds its nested layers, of which
    unfolded streams take ``LAYER_BYTES`` in all.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan(F.col("text")).alias("s")).select("doc_id", "s.*")
