"""Secrets in texts, also below layers of encoding.

Three kinds are looked for in the text as it stands (*base* spans). Then a worklist unwraps what
is encoded in it: percent escapes and Unicode escapes are undone in place, base64 runs become layers
of their own at each of four alignments, so that what stands in front of a code doesn't hide it, and
compressed data that begin anywhere in them, or in the bytes of percent and ``\\x`` escapes, are
inflated. Every layer is scanned and unwrapped again until nothing new comes out; a layer that has
been seen for the same place in the document is not taken up again at the same depth or a deeper one, which
ends cycles. What a layer
holds is reported with the span of the original text that it comes from, in code points.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallystream.llm.common import text_or_empty

ASSIGN, ACCESS, HEX = KINDS = ("assign", "access", "hex")
_ORDER = {kind: n for n, kind in enumerate(KINDS)}
_ASSIGN = re.compile(
    "(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
# The largest run from a place on is taken either way, so the length can stand in the pattern.
_HEX = re.compile("[0-9a-f]{32,}")

_PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}")
_BASE64 = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
#: How gzip and zlib data (without a dictionary) begin.
_COMPRESSED = re.compile(b"\x1f\x8b\x08|[\x08\x18\x28\x38\x48\x58\x68\x78]", re.DOTALL)
_URL_SAFE = str.maketrans("-_", "+/")
#: Runs that may be bytes in escapes, and what makes one byte of them.
_BYTES = {
    "percent": ("%", re.compile("[A-Za-z0-9%_.~!*'()$,;:@/+-]+"), re.compile("%([0-9A-Fa-f]{2})|([^\n])")),
    "unicode": ("\\x", re.compile("[\x20-\x7e]+"), re.compile(r"\\x([0-9A-Fa-f]{2})|(\\[abfnrtv0\\'\"]|[^\n])")),
}
_SHORT = {f"\\{c}": ord(b) for c, b in zip("abfnrtv0\\'\"", "\a\b\f\n\r\t\v\0\\'\"")}
_RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\{}"
#: Inflated data are scanned in stretches of this size, each beginning with the end of the last:
#: so many characters, and the whole of a run that may be a code and is not over.
INFLATE_BYTES, OVERLAP_CHARS = 8 << 20, 1 << 16

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("layers", T.StringType()),
        ]
    )
)
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("found", SPANS)])
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("layers", pa.string())])
)


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of each kind in one layer."""
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                yield ASSIGN, m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                yield ACCESS, m.start(), m.end()
    for m in _HEX.finditer(text):
        yield HEX, m.start(), m.end()


class Layer:
    """A text and where its characters come from: at themselves, all at one span, or each at its own."""

    __slots__ = ("text", "how", "whole", "starts", "ends")

    def __init__(self, text: str, how: str, whole=None, starts=None, ends=None):
        self.text, self.how, self.whole, self.starts, self.ends = text, how, whole, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]

    def below(self, name: str) -> str:
        return f"{self.how}>{name}" if self.how else name

    def key(self) -> tuple:
        return hash(self.text), len(self.text), self.whole or (self.origin(0, 1)[0], self.origin(0, len(self.text))[1])


def _percent(run: str) -> list[tuple[str, int]]:
    """Characters of a run of percent escapes, each with the length of its escapes."""
    data = bytes.fromhex(run.replace("%", ""))
    try:
        return [(c, 3 * len(c.encode())) for c in data.decode()]
    except UnicodeDecodeError:
        return [(chr(b), 3) for b in data]


def _unicode(run: str) -> list[tuple[str, int]]:
    if run[1] != "u" or run[2] == "{":
        value = int(run[3:-1] if run[2] == "{" else run[2:], 16)
        return [(chr(value) if value < 0x110000 else "\ufffd", len(run))]
    units = b"".join(int(run[i + 2 : i + 6], 16).to_bytes(2, "little") for i in range(0, len(run), 6))
    found = units.decode("utf-16-le", "surrogatepass" if len(units) < 4 else "replace")
    found = "".join(c if not 0xD800 <= ord(c) < 0xE000 else "\ufffd" for c in found)
    return [(c, 12 if ord(c) > 0xFFFF else 6) for c in found]


def _rewritten(layer: Layer, name: str, pattern: re.Pattern, undo) -> Layer | None:
    """The layer with all runs of one escape undone in place."""
    text, parts, starts, ends, at = layer.text, [], array("q"), array("q"), 0
    for m in pattern.finditer(text):
        parts.append(text[at : m.start()])
        starts.extend(range(at, m.start()))
        ends.extend(range(at + 1, m.start() + 1))
        place = m.start()
        for c, size in undo(m.group()):
            parts.append(c)
            starts.append(place)
            ends.append(min(place + size, m.end()))
            place = min(place + size, m.end() - 1)
        at = m.end()
    if not at:
        return None
    parts.append(text[at:])
    starts.extend(range(at, len(text)))
    ends.extend(range(at + 1, len(text) + 1))
    if layer.whole:
        return Layer("".join(parts), layer.below(name), whole=layer.whole)
    if layer.starts is not None:
        starts = array("q", (layer.starts[i] for i in starts))
        ends = array("q", (layer.ends[i - 1] for i in ends))
    return Layer("".join(parts), layer.below(name), starts=starts, ends=ends)


def _inflated(data: bytes | memoryview) -> Generator[str, None, int]:
    """Text of zlib or gzip data, member after member, in overlapping stretches; ends where the data
    are damaged. Returns the size of the members that are whole."""
    size, whole, held = len(data), 0, [""]
    while len(data):
        machine = zlib.decompressobj(47)
        while not machine.eof:
            try:
                out = machine.decompress(data, INFLATE_BYTES)
            except zlib.error:
                out, data, broken = b"", b"", True
            else:
                data, broken = machine.unused_data if machine.eof else machine.unconsumed_tail, False
            part = out.decode("utf-8", "replace")
            if len(data) and not part.rstrip(_RUN):
                held.append(part)
                continue
            if part or len(held) > 1:
                text = "".join([*held, part])
                yield text
                held = [text[-max(OVERLAP_CHARS, len(part) - len(part.rstrip(_RUN))) :]]
            if broken or not out and not len(data):
                break
        if not machine.eof:
            break
        whole = size - len(data)
    return whole


def _base64(run: str) -> Iterator[bytes]:
    """What a run holds from each alignment on. A code that begins after other base64 characters is
    whole in one of them; a last character that makes no byte is left."""
    bare = run.rstrip("=").translate(_URL_SAFE)
    for skip in range(4):
        size = len(bare) - skip
        part = bare[skip : len(bare) - (size % 4 == 1)]
        if data := base64.b64decode(part + "=" * (-len(part) % 4)):
            yield data


def _compressed(data: bytes) -> Iterator[tuple[str, int]]:
    """Text of the compressed data that begin anywhere in ``data``, and where."""
    at = 0
    while m := _COMPRESSED.search(data, at):
        at = m.start()
        if len(m.group()) > 1 or at + 1 < len(data) and (data[at] << 8 | data[at + 1]) % 31 == 0 and not data[at + 1] & 32:
            size, texts = 0, _inflated(memoryview(data)[at:])
            while True:
                try:
                    text = next(texts)
                except StopIteration as over:
                    size = over.value
                    break
                yield text, at
            at += max(1, size)
        else:
            at += 1


def _escaped(layer: Layer, name: str) -> Iterator[Layer]:
    """Compressed data whose bytes are escaped, or stand as they are between escapes."""
    mark, runs, byte = _BYTES[name]
    for m in runs.finditer(layer.text):
        run = m.group()
        if mark not in run:
            continue
        data, starts = bytearray(), array("q")
        for unit in byte.finditer(run):
            starts.append(m.start() + unit.start())
            plain = unit.group(2)
            data.append(int(unit.group(1), 16) if plain is None else _SHORT[plain] if len(plain) > 1 else ord(plain))
        starts.append(m.end())
        tries = [bytes(data)]
        if name == "percent" and "+" in run:  # a space in forms
            tries.append(bytes(32 if run[at - m.start()] == "+" else b for b, at in zip(data, starts)))
        for some in tries:
            for inside, at in _compressed(some):
                place = layer.origin(starts[at], starts[-1])
                yield Layer(inside, layer.below(f"{name}>compressed"), whole=place)


def unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers right below one."""
    text = layer.text
    if "%" in text and (below := _rewritten(layer, "percent", _PERCENT, _percent)):
        yield below
    if "\\" in text and (below := _rewritten(layer, "unicode", _ESCAPE, _unicode)):
        yield below
    for name, (mark, _, _) in _BYTES.items():
        if mark in text:
            yield from _escaped(layer, name)
    for m in _BASE64.finditer(text):
        place = layer.origin(m.start(), m.end())
        for data in _base64(m.group()):
            for inside, _ in _compressed(data):
                yield Layer(inside, layer.below("base64>compressed"), whole=place)
            try:
                inside = data.decode()
            except UnicodeDecodeError:
                inside = data.decode("latin-1")
            yield Layer(inside, layer.below("base64"), whole=place)


def scan(text: str) -> list[tuple[str, int, int, str]]:
    """All spans (kind, start, end, layers) of a text by start and kind; base spans have no layers.

    The worklist is a stack of layers that are being unwrapped: a layer is scanned as soon as it comes out,
    and what lies below it before the next one of the same depth, so only one layer of each depth is held
    at a time, however much is inflated. A layer that was met deeper before is taken up again,
    so a span keeps the name of the outermost layers that show it.
    """
    found: dict[tuple[str, int, int], tuple[int, str]] = {}
    seen: dict[tuple, int] = {}

    def look(layer: Layer, depth: int) -> None:
        for kind, start, end in matches(layer.text):
            span = (kind, *layer.origin(start, end))
            if span not in found or depth < found[span][0]:
                found[span] = depth, layer.how

    first = Layer(text, "")
    look(first, 0)
    work = [(first, unwrapped(first))] if text else []
    while work:
        above, rest = work[-1]
        below = next(rest, None)
        if below is None:
            work.pop()
        elif below.text and below.text != above.text:
            depth, key = len(work), below.key()
            if depth < seen.get(key, depth + 1):
                seen[key] = depth
                look(below, depth)
                work.append((below, unwrapped(below)))
    return sorted(((k, s, e, how) for (k, s, e), (_, how) in found.items()), key=lambda x: (x[1], _ORDER[x[0]], x[2]))


def scan_secrets(documents: DataFrame) -> DataFrame:
    """Per row: doc_id and the spans found in its whole text.

    Null and empty texts have none; equal rows have equal results; other columns are not read.
    Spans that two layers give alike are listed once, as the outermost one's.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e, "layers": how} for k, s, e, how in scan(t)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _ARROW_SPANS)], FOUND.names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(look, FOUND)


def span_digests(found: DataFrame) -> DataFrame:
    """Base spans counted by kind and digested; all spans as text."""
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("found", lambda s: s["layers"] == "")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("found")).alias("spans"),
    )
