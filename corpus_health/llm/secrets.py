"""Secret scans that unwrap encoded layers.

Each text starts a worklist. A layer is scanned for secrets, then every encoded
run in it (URL escapes, Unicode escapes, base64, and compressed bytes behind
base64) is decoded into a new layer that joins the worklist, until no layer is
left. Layers seen before in the same text are skipped, which ends cycles. A find
in a layer is mapped to code points of the text itself: to the characters it was
written with where the escapes tell, and to the whole encoded run where not
(base64, compressed bytes).
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import SLICE, map_rows

KINDS = ("assign", "access", "hex")

#: What counts as a secret.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: What a layer needs before the slower patterns are tried on it.
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_URL_RUN = re.compile(r"[^\s\"'<>]+")
_UNICODE_RUN = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#x[0-9A-Fa-f]{1,6};)+")
_UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#x([0-9A-Fa-f]{1,6});")
_BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_BASE64_LINES = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]+)+={0,2}")
_URL_ONE = re.compile(r"%[0-9A-Fa-f]{2}")
_STREAM = re.compile(rb"\x1f\x8b\x08|[\x08\x18\x28\x38\x48\x58\x68\x78](?=.)", re.S)
_CHUNK = 1 << 16

#: Bytes that one compressed layer may open to; beyond, the layer is read in windows of about this size. A window ends
#: before what may go on in the next one and starts with the end of the one before.
WINDOW = 1 << 24
_OVERLAP = 1 << 12
_ENDS = " \t\n\r\x0b\x0c\"'<>"
_WRAPPED_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=\r\n"


class Layer:
    """A text with, for each character, where it comes from in the outermost text.

    `at` is None for the outermost text; otherwise a list of (start, end) for each
    character, or one pair for all.
    """

    __slots__ = ("text", "at")

    def __init__(self, text: str, at):
        self.text, self.at = text, at

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.at is None:
            return start, end
        if isinstance(self.at, tuple):
            return self.at
        return self.at[start][0], self.at[end - 1][1]


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the secrets written plainly in a text."""
    data = text.encode("utf-8", "surrogatepass")
    low = data.lower()
    found = []
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _text(data: bytes) -> str:
    """The bytes as text; what is not UTF-8 is replaced, which leaves all ASCII, and so every secret, as it is."""
    return data.decode("utf-8", "replace")


def _inflate(data: bytes, at: int, bits: int, end: list[int] | None = None):
    """Pieces of what the gzip, zlib (bits 47) or raw-deflate (bits -15) bytes from `at` on hold, one gzip member after another.

    `end` gets where the last member that ended well ends.
    """
    view, begin = memoryview(data), at
    try:
        while at < len(view):
            stream = zlib.decompressobj(bits)
            while not stream.eof and at < len(view):
                rest = view[at : at + min(_CHUNK, max(1 << 10, at - begin))]
                at += len(rest)
                while True:
                    part = stream.decompress(rest, WINDOW)
                    rest = stream.unconsumed_tail
                    if part:
                        yield part
                    if not rest and len(part) < WINDOW:
                        break
            if not stream.eof:
                return
            at -= len(stream.unused_data)
            if end is not None:
                end[:] = [at]
            if bits < 0:
                return
    except zlib.error:
        pass


def _streams(data: bytes, raw: list[int]):
    """(start, end, bits) of the compressed streams in some bytes: gzip and zlib anywhere, raw deflate at the given places."""
    after = 0
    places = [(m.start(), 47) for m in _STREAM.finditer(data) if m.end() - m.start() == 3 or (data[m.start()] << 8 | data[m.start() + 1]) % 31 == 0]
    for at, bits in sorted(places + [(at, -15) for at in raw], key=lambda p: (p[0], -p[1])):
        if at < after:
            continue
        end: list[int] = []
        got = False
        for _ in _inflate(data, at, bits, end):
            got = True
        if got:
            yield at, end[0] if end else len(data), bits
        if end and bits > 0:
            after = end[0]


def _unfinished(text: str) -> int:
    """Where the run at the end of a text starts that may go on after it: one without a gap, or lines of base64."""
    at = max(text.rfind(c) for c in _ENDS) + 1
    return min(at, len(text.rstrip(_WRAPPED_CHARACTERS)))


def _windows(pieces):
    """Texts of about WINDOW characters that cover the pieces of a layer; no character and no run is cut in two.

    A run that does not end within a window is kept until it does, whatever its length.
    """
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    before, held, size = "", [], 0  # before: looked at already; held: not yet
    for piece in pieces:
        held.append(decoder.decode(piece))
        size += len(held[-1])
        if size < WINDOW:
            continue
        at = _unfinished(held[-1])
        if not at:
            continue
        text = before + "".join(held[:-1]) + held[-1][:at]
        yield text
        before, held = text[-_OVERLAP:], [held[-1][at:]]
        size = 0
    held.append(decoder.decode(b"", True))
    if last := "".join(held):
        yield before + last


def _base64(run: str):
    """(bytes, places where raw deflate may start) of a run decoded from each of its first four characters on.

    What stands before the payload in the same run is a multiple of four away from one of them.
    """
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    starts = [0, *(m.end() for m in re.finditer(r"[/_-]", run.rstrip("=")))]
    for first in range(4):
        part = body[first:]
        part = part[:-1] if len(part) % 4 == 1 else part
        try:
            data = base64.b64decode(part + "=" * (-len(part) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        yield data, [(x - first) // 4 * 3 for x in starts if x % 4 == first and (x - first) // 4 * 3 < len(data)]


def _opened(data: bytes, raw: list[int], span):
    """The layers that compressed streams in some bytes hold; `span(start, end)` tells where their bytes come from."""
    for at, end, bits in _streams(data, raw):
        for text in _windows(_inflate(data, at, bits)):
            yield Layer(text, span(at, end))


def _decode_lines(layer: Layer, m: re.Match):
    """The layers of a base64 run over several lines, each byte with the characters that it is written with."""
    where = [i for i in range(m.start(), m.end()) if layer.text[i] not in "\r\n="]
    for first, (data, raw) in enumerate(_base64("".join(layer.text[i] for i in where))):
        fours = [where[i : i + 4] for i in range(first, len(where), 4)]
        at = [layer.span(f[0], f[-1] + 1) for f in fours for _ in range(3)][: len(data)]
        if data:
            yield Layer(data.decode("latin-1"), at)
            yield from _opened(data, raw, lambda a, b, at=at: (at[a][0], at[b - 1][1]))


def _decode_url(layer: Layer, m: re.Match):
    """The run with its escapes replaced, and what compressed bytes in it hold."""
    raw, at, i, run = bytearray(), [], 0, m.group()
    while i < len(run):
        step = 3 if _URL_ONE.match(run, i) else 1
        piece = unquote_to_bytes(run[i : i + step])
        raw += piece
        at += [layer.span(m.start() + i, m.start() + i + step)] * len(piece)
        i += step
    first = _URL_ONE.search(run).start()
    yield from _opened(bytes(raw), sorted({0, first}), lambda a, b: (at[a][0], at[b - 1][1]))
    text = _text(raw)
    spans, b = [], 0
    if len(text.encode("utf-8", "surrogatepass")) != len(raw):  # bytes that are not UTF-8: the whole run
        yield Layer(text, layer.span(m.start(), m.end()))
        return
    for c in text:
        n = len(c.encode("utf-8", "surrogatepass"))
        spans.append((at[b][0], at[b + n - 1][1]))
        b += n
    yield Layer(text, spans)


def _decode_unicode(layer: Layer) -> Layer:
    """The whole layer with its escapes replaced, so that a secret may be escaped in part."""
    out, at, last, text = [], [], 0, layer.text
    for m in _UNICODE_ONE.finditer(text):
        out.append(text[last : m.start()])
        at += [layer.span(i, i + 1) for i in range(last, m.start())]
        u, x, dec, hexa = m.groups()
        code = int(u or x or hexa, 16) if (u or x or hexa) else int(dec)
        out.append(chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�")
        at.append(layer.span(m.start(), m.end()))
        last = m.end()
    out.append(text[last:])
    at += [layer.span(i, i + 1) for i in range(last, len(text))]
    return Layer("".join(out), at)


def _unwrap(layer: Layer):
    """The layers that the encoded runs of a layer hold."""
    text = layer.text
    if "%" in text and _URL_ONE.search(text):
        for m in _URL_RUN.finditer(text):
            if _URL_ONE.search(m.group()):
                yield from _decode_url(layer, m)
    if ("\\" in text or "&#" in text) and _UNICODE_RUN.search(text):
        plain = _decode_unicode(layer)
        yield plain
        raw = plain.text.encode("latin-1", "replace")  # a byte for each character
        yield from _opened(raw, [], plain.span)
    for m in _BASE64_RUN.finditer(text):
        span = layer.span(m.start(), m.end())
        for data, raw in _base64(m.group()):
            yield Layer(_text(data), span)
            yield from _opened(data, raw, lambda a, b, span=span: span)
    if "\n" in text:
        for m in _BASE64_LINES.finditer(text):
            yield from _decode_lines(layer, m)


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(plain secrets, all secrets) of a text as sorted (start, kind number, end)."""
    base = scan(text)
    every, seen = set(base), {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}
    work = [_unwrap(Layer(text, None))]  # a stack of the layers still to come: one path of them is in memory
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        at = layer.at if isinstance(layer.at, tuple) else (layer.at[0][0], layer.at[-1][1]) if layer.at else (0, 0)
        key = hashlib.sha256(f"{at}".encode() + layer.text.encode("utf-8", "surrogatepass")).digest()
        if key in seen:
            continue
        seen.add(key)
        for start, kind, end in scan(layer.text):
            a, b = layer.span(start, end)
            every.add((a, kind, b))
        work.append(_unwrap(layer))
    return base, sorted(every)


def written(found: list[tuple[int, int, int]]) -> str:
    """kind:start:end of each find, by start and then kind, joined by commas."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def redact(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each find (overlapping ones together) replaced by a mark with the first one's kind."""
    out, last, i = [], 0, 0
    while i < len(found):
        a, kind, b = found[i]
        i += 1
        while i < len(found) and found[i][0] < b:
            b = max(b, found[i][2])
            i += 1
        out += [text[last:a], f"<{KINDS[kind]}>"]
        last = b
    return "".join([*out, text[last:]])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_spans, spans, redacted: secrets of each document's whole text.

    The counts and base_spans are those of secrets written plainly; spans adds those
    behind encodings. A null text has none and is redacted to the empty text. Every
    row gets its own result; columns besides doc_id and text are not read.
    """

    def begin():
        def run(ids, texts):
            texts = [t or "" for t in texts]
            finds = [find(t) for t in texts]
            counts = [[sum(f[1] == k for f in base) for base, _ in finds] for k in range(3)]
            base = [written(b) for b, _ in finds]
            every = [written(e) for _, e in finds]
            return ids, *counts, base, every, [redact(t, e) for t, (_, e) in zip(texts, finds, strict=True)]

        return run

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string, redacted string"
    return map_rows(docs.select("doc_id", "text"), schema, begin)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns as they were, with secrets in `text` replaced by marks and `n_chars` to match.

    Null texts stay null, with their n_chars. Other columns pass through as they are, whatever their names.
    """
    names = docs.columns

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = dict(zip(names, part.columns, strict=True))
                texts = [None if t is None else redact(t, find(t)[1]) for t in columns["text"].to_pylist()]
                columns["text"] = pa.array(texts, type=columns["text"].type)
                if "n_chars" in columns:
                    old = columns["n_chars"]
                    counts = [n if t is None else len(t) for t, n in zip(texts, old.to_pylist(), strict=True)]
                    columns["n_chars"] = pa.array(counts, type=old.type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(task, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    """The finds of each document with a digest of the plain ones."""
    found = scan_secrets(docs)
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )
