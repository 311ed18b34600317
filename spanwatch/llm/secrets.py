"""Secrets in texts and in what texts encode, by a recursive worklist of layers."""

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.scratch import documents, texts
from spanwatch.llm.words import pieces

MAX_OUTPUT = 64 << 20  # characters that one compressed layer may unfold to; beyond it is reported as unread

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
NESTED = re.compile(r"%(?:25)+([0-9A-Fa-f]{2})")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
ESCAPE = re.compile(
    r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?:[A-Za-z0-9+/]{60,80}\r?\n)+[A-Za-z0-9+/]{2,80}={0,2}")
SEPARATOR = re.compile(r"[/_-]")
# The first bytes of zlib and gzip, bzip2 and xz streams.
DEFLATED = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
PACKED = (*DEFLATED, b"BZh", b"\xfd7zXZ\x00")
PROBE = 32  # characters of a run that tell whether a code may begin there
FED = 1 << 16  # bytes of a stream that are unpacked at a time


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets that stand in ``text`` itself."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def _escapes(text: str) -> str:
    def char(m: re.Match) -> str:
        code = int(m[1] or m[2] or m[3] or m[5] or "0", 16) if m[4] is None else int(m[4])
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]

    return ESCAPE.sub(char, text)


def _percent(text: str) -> str | None:
    """Escapes of escapes (%2541 for %41) come off at once if the result is text, else layer by layer."""
    return _text(unquote_to_bytes(NESTED.sub(r"%\1", text))) or _text(unquote_to_bytes(text))


def _text(data: bytes, errors: str = "strict") -> str | None:
    """``data`` as text, if it is UTF-8 of mostly printable characters; a character cut off at the end is left out."""
    try:
        text = codecs.getincrementaldecoder("utf-8")(errors).decode(data)
    except UnicodeDecodeError:
        return None
    said = text.translate({9: None, 10: None, 13: None})
    if not said.isprintable() or errors != "strict":
        odd = len(said) - sum(map(str.isprintable, said)) + text.count("\ufffd")
        if odd * 10 > len(text):
            return None
    return text or None


@dataclass
class Layer:
    """A text with, for each stretch of it, the stretch of the document that it came from.

    A stretch is (start, end, origin start, origin end, exact); an exact one maps character by
    character, the others as a whole.
    """

    text: str
    pieces: list[tuple[int, int, int, int, bool]]
    depth: int

    def origin(self, start: int, end: int) -> tuple[int, int]:
        lo, hi = None, None
        for a, b, x, y, exact in self.pieces:
            if a < end and start < b:
                lo = min(x + max(start - a, 0) if exact else x, lo if lo is not None else 1 << 60)
                hi = max(x + min(end, b) - a if exact else y, hi or 0)
        return lo, hi


@dataclass
class Found:
    spans: set = field(default_factory=set)
    depth: int = 0
    unread: int = 0


def _rewritten(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with all matches of ``pattern`` decoded in place."""
    parts, stretches, at, size = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        new = decode(m[0])
        if new is None or new == m[0]:
            continue
        for a, b, whole in ((at, m.start(), layer.text[at : m.start()]), (m.start(), m.end(), new)):
            if whole:
                parts.append(whole)
                stretches.append((size, size + len(whole), a, b))
                size += len(whole)
        at = m.end()
    if not parts:
        return None
    if at < len(layer.text):
        parts.append(layer.text[at:])
        stretches.append((size, size + len(layer.text) - at, at, len(layer.text)))
    return _below(layer, "".join(parts), stretches)


def _below(layer: Layer, text: str, stretches: list[tuple[int, int, int, int]]) -> Layer:
    pieces_ = []
    for a, b, x, y in stretches:
        same = b - a == y - x and text[a:b] == layer.text[x:y]
        inner = [p for p in layer.pieces if p[0] < y and x < p[1]]
        if same:
            for p in inner:  # the stretch is cut where the layer above is
                lo, hi = max(p[0], x), min(p[1], y)
                o = (p[2] + lo - p[0], p[2] + hi - p[0]) if p[4] else (p[2], p[3])
                pieces_.append((a + lo - x, a + hi - x, *o, p[4]))
        else:
            pieces_.append((a, b, *layer.origin(x, y), False))
    return Layer(text, _joined(pieces_), layer.depth + 1)


def _joined(stretches: list[tuple[int, int, int, int, bool]]) -> list[tuple[int, int, int, int, bool]]:
    """Neighbours that map as a whole to the same place as one: equal layers of a place look equal."""
    out: list[tuple[int, int, int, int, bool]] = []
    for p in stretches:
        if out and not p[4] and not out[-1][4] and p[2:4] == out[-1][2:4] and p[0] == out[-1][1]:
            out[-1] = (out[-1][0], p[1], *p[2:])
        else:
            out.append(p)
    return out


def _stream(data: bytes):
    if data.startswith(DEFLATED):
        return zlib.decompressobj(wbits=47)  # zlib or gzip
    return bz2.BZ2Decompressor() if data.startswith(b"BZh") else lzma.LZMADecompressor()


def _unpacked(data: bytes, found: Found) -> bytes:
    """All members of a compressed stream one after the other, as far as they can be read and up to MAX_OUTPUT."""
    whole, out, size = data, [], 0
    while data.startswith(PACKED):
        stream, at, broken = _stream(data), 0, False
        try:
            while not stream.eof and at < len(data) and size <= MAX_OUTPUT:
                fed = data[at : at + FED]
                at += len(fed)
                while fed or not getattr(stream, "needs_input", True):
                    part = stream.decompress(fed, MAX_OUTPUT - size + 1)
                    out.append(part)
                    size += len(part)
                    fed = getattr(stream, "unconsumed_tail", b"")
                    if stream.eof or size > MAX_OUTPUT:
                        break
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            broken = True
        if broken and not size:
            return whole
        if broken or not stream.eof:
            found.unread += 1
            break
        data = stream.unused_data + data[at:]
    return b"".join(out)[:MAX_OUTPUT]


def _decoded(core: str) -> bytes | None:
    core = core[: len(core) - (len(core) % 4 == 1)]
    try:
        return base64.b64decode(core + "=" * (-len(core) % 4), validate=True)
    except binascii.Error:
        return None


def _unwrapped(core: str, found: Found, errors: str = "strict") -> str | None:
    """The text that a run of base64 stands for, out of any compressed streams."""
    data, seen, packed = _decoded(core), set(), False
    while data is not None and data.startswith(PACKED) and _digest(data) not in seen:
        seen.add(_digest(data))
        data = _unpacked(data, found)
        packed = True
    return None if data is None else _text(data, "strict" if packed else errors)


def _begins(core: str) -> bool:
    """Whether the first characters of a run decode to the beginning of a text or of a stream."""
    data = _decoded(core[: min(PROBE, len(core) // 4 * 4)])
    return data is not None and (data.startswith(PACKED) or _text(data) is not None)


def _goes_on(core: str) -> bool:
    """Whether characters within a run decode to the middle of a text."""
    data = _decoded(core)
    return data is not None and _text(data, "replace") is not None


def _base64(match: str, found: Found) -> tuple[int, str] | None:
    """Where in a run its code begins, and what this stands for.

    Usually that is the whole run. But paths and names are made of the same characters, so a code may also
    begin after any / - or _ in it, or in the other three alignments; what stands before or behind it then may
    decode to a few odd characters.
    """
    core = match.rstrip("=")
    joined = "".join(core.split()).replace("-", "+").replace("_", "/")
    text = _unwrapped(joined, found) if len(joined) % 4 != 1 else None
    if text is not None:
        return 0, text
    if len(joined) != len(core):  # a code over several lines begins with its first
        return None
    for at in [m.end() for m in SEPARATOR.finditer(core)]:
        if len(core) - at >= 16 and _begins(joined[at:]):
            text = _unwrapped(joined[at:], found, "replace")
            if text is not None:
                return at, text
    for at in (0, 1, 2, 3):
        if len(joined) >= 4 * PROBE and not (_goes_on(joined[at + PROBE : at + 3 * PROBE]) or _begins(joined[at:])):
            continue
        text = _unwrapped(joined[at:], found, "replace") if len(joined) - at >= 16 else None
        if text is not None:
            return at, text
    return None


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def all_spans(text: str) -> Found:
    """The secrets of ``text`` and of every layer that it encodes, in spans of ``text``.

    Worklist: each layer is scanned, and its runs of URL escapes, Unicode escapes and base64
    (compressed or not) are decoded into new layers, until nothing new comes up. A layer is entered
    again for each place of the document that it stands in, but once only for the same one: cycles end,
    since what a code decodes to has the place of the code.
    """
    found = Found({(s, k, e) for s, k, e in base_spans(text)})
    work = [Layer(text, [(0, len(text), 0, len(text), True)], 0)]
    mark = lambda x: (_digest(x.text.encode("utf-8", "surrogatepass")), tuple(x.pieces))
    done = {mark(work[0])}
    while work:
        layer = work.pop()
        found.depth = max(found.depth, layer.depth)
        new: list[Layer | None] = []
        if "%" in layer.text:
            new.append(_rewritten(layer, PERCENT, _percent))
        if "\\" in layer.text or "&#" in layer.text:
            new.append(_rewritten(layer, UNICODE, _escapes))
        for pattern in (BASE64, WRAPPED):
            for m in pattern.finditer(layer.text):
                inner = _base64(m[0], found)
                if inner is not None:
                    at, said = inner
                    new.append(_below(layer, said, [(0, len(said), m.start() + at, m.end())]))
        for below in new:
            if below is None:
                continue
            for start, kind, end in base_spans(below.text):
                lo, hi = below.origin(start, end)
                found.spans.add((lo, kind, hi))
            if mark(below) not in done:
                done.add(mark(below))
                work.append(below)
    return found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    join = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    for batch in pieces(batches, "text"):
        out = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            found = all_spans(text or "")
            spans = sorted(found.spans)
            out.append({
                "n": [sum(k == kind for _, k, _ in base) for kind in range(3)],
                "digest": hashlib.sha256(join(base).encode()).hexdigest(),
                "spans": [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans],
                "all": join(spans), "depth": found.depth, "unread": found.unread,
            })
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *[pa.array([o["n"][k] for o in out], pa.int64()) for k in range(3)],
                pa.array([o["digest"] for o in out], pa.string()), pa.array([o["all"] for o in out], pa.string()),
                pa.array([o["spans"] for o in out], SPANS),
                pa.array([o["depth"] for o in out], pa.int32()), pa.array([o["unread"] for o in out], pa.int32()),
            ],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "joined", "spans", "layers", "unread_layers"],
        )


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every row of ``docs`` (doc_id, text), one row each.

    n_assign, n_access, n_hex and base_sha256 tell of the secrets in the text itself; spans (and
    ``joined``, the same as text) also of those in encoded layers, which span the code that
    holds them. layers is the depth reached. Unwrapped are URL and Unicode escapes, base64 in both alphabets,
    and zlib, gzip (all members), bzip2 and xz streams within base64; not raw deflate, which nothing marks. A stream
    that is broken, cut off, or unfolds to more than MAX_OUTPUT bytes is read up to there and counted in unread_layers.

    Null is an empty text. Rows are scanned one by one, equal or not; other columns are not read.
    """
    return texts(docs).mapInArrow(
        _scan,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, joined string, "
        "spans array<struct<kind:string,start:int,end:int>>, layers int, unread_layers int",
    )


def op9_secret_scan(spark, sf_dir) -> DataFrame:
    return find_secrets(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.col("joined").alias("spans"),
        "layers", "unread_layers",
    )
