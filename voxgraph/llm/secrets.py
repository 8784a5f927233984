"""Secret scans through nested encodings.

Three kinds of secret are looked for in a text: ``assign`` (a name such as
password, followed by ``=`` or ``:`` and a value), ``access`` (cloud access
ids) and ``hex`` (long runs of hexadecimal digits).  Encoded regions are then
unwrapped (percent-encoding, Unicode escapes, base64, gzip, zlib, bzip2, xz and
zstandard) and every layer is scanned again, by a worklist, until nothing new
can be unwrapped.  A layer is opened once for each place of the document that
encodes it: copies elsewhere get spans of their own, and cycles end, as what
stands in a place never leaves it.  Base64 that is wrapped into lines is joined
first; where a run does not decode as a whole, texts and compressed blocks are
looked for in it at all four alignments.  Spans of inner layers are mapped back to
the characters of the document that encode them.

Rows: one for each input row, repeated rows alike; an empty table has none.
Null is an empty text and has no spans; texts of any length are scanned whole.
Only the id and the text are read; other columns can have any name.  Spans are
in code points, end exclusive, ordered by start, then by kind as listed,
then by end; equal spans found in several layers count once.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K

KINDS = ("assign", "access", "hex")

# The patterns of the kinds and the least length of each match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 12
# A maximal run shorter than the least length holds no longer run, so that the length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

_NAMED = re.compile(r"[:=]")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of base64 that follow each other; all between the first and the last have one width.
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+")
_BREAK = re.compile(r"\r?\n[ \t]*")
#: Stretches of text in bytes, as long as the shortest secret, and beginnings of compressed blocks.
_STRETCH = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){16,}")
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: A compressed layer that unpacks to more bytes is scanned in pieces to its end and marked, so that a small text cannot fill the memory.
MAX_LAYER_BYTES = 1 << 26
#: Bytes of a piece, and how many of them the next piece repeats; what is encoded at greater length than that may be missed, hence the mark.
PIECE_BYTES, REPEATED_BYTES = 1 << 24, 1 << 20


@dataclass(frozen=True)
class Layer:
    """A decoded text and, for its pieces, where each lies in the document.

    Piece i begins at ``at[i]`` of the layer and stands for the document's
    ``[lo[i], hi[i])``; with ``step[i]`` characters per layer character it can
    be cut finely (0: only as a whole), after ``skip[i]`` characters of it that
    other pieces hold.
    """

    text: str
    at: list[int]
    lo: list[int]
    hi: list[int]
    step: list[float]
    skip: list[int]

    def span(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        lo = self.lo[i] + int((start - self.at[i] + self.skip[i]) * self.step[i])
        hi = self.lo[j] - int(-(end - self.at[j] + self.skip[j]) * self.step[j] // 1) if self.step[j] else self.hi[j]
        return lo, max(lo + 1, min(hi, self.hi[j]) if self.step[j] != 1 else hi)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end), leftmost and not overlapping within a kind; matches that are too short are dropped."""
    out = []
    if _NAMED.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _text(raw: bytes) -> str | None:
    """Decoded text, if the bytes are mostly printable."""
    try:
        s = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = sum(not (c.isprintable() or c in "\n\r\t") for c in s)
    return s if s and odd * 10 <= len(s) else None


_STEP = 1 << 20
_ZLIB = type(zlib.decompressobj())


def _opener(raw: bytes) -> Callable[[], object] | None:
    """Makes the decompressor of a block that its first bytes show."""
    if raw[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31)
    if raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return zlib.decompressobj
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj
    return None


_BROKEN = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError)


def _member(source: list[bytes], more: Iterator[bytes]) -> Iterator[bytes]:
    """Contents of the block that ``source[0]`` begins, in bounded pieces; what follows the block is left there."""
    d, data = _opener(source[0])(), source[0]
    source[0] = b""
    while True:
        if isinstance(d, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
            out, rest, data = d.decompress(data, _STEP), b"", b""
            hungry = d.needs_input
        elif isinstance(d, _ZLIB):
            out, rest = d.decompress(data, _STEP), b""
            data = d.unconsumed_tail
            hungry = not data and len(out) < _STEP
        else:  # the output of zstandard has no bound, so that its input is small
            out, data = d.decompress(data[:256]), data[256:]
            rest, hungry = data, not data
        if out:
            yield out
        if d.eof:
            source[0] = d.unused_data + rest
            return
        if hungry:
            if not (data := next(more, b"")):
                return


def contents(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed blocks one after the other contain, to the end of all; anything else that follows comes as it is."""
    source = [b""]
    while len(source[0]) < 6 and (x := next(chunks, b"")):
        source[0] += x
    first = True
    while source[0]:
        if _opener(source[0]) is None:
            yield source[0]
            source[0] = b""
        else:
            rest = source[0]
            try:
                yield from _member(source, chunks)
            except _BROKEN:
                if first:
                    raise
                yield rest
        first = False
        while len(source[0]) < 6 and (x := next(chunks, b"")):
            source[0] += x


def unpack(raw: bytes, most: int = MAX_LAYER_BYTES) -> tuple[bytes, bool] | None:
    """(content, whether it was cut) of compressed blocks that the first bytes show."""
    if _opener(raw) is None:
        return None
    parts, size = [], 0
    try:
        for x in contents(iter([raw])):
            parts.append(x)
            size += len(x)
            if size > most:
                break
    except _BROKEN:
        return None
    return b"".join(parts)[:most], size > most


def _pieces(raw: bytes, depth: int) -> Iterator[str]:
    """Text of ``depth`` times compressed bytes, in overlapping bounded pieces."""
    chunks = iter([raw])
    for _ in range(depth):
        chunks = contents(chunks)
    held, new = b"", 0
    try:
        for x in chunks:
            held += x
            new += len(x)
            if new >= PIECE_BYTES:
                yield held.decode("utf-8", "replace")
                held, new = held[-REPEATED_BYTES:], 0
    except _BROKEN:
        pass
    if new:
        yield held.decode("utf-8", "replace")


def _inflate(raw: bytes) -> Iterator[tuple[str, bool]]:
    """Text of possibly repeatedly compressed bytes; if it is large, in pieces that are marked."""
    first, seen, cut = raw, set(), False
    while (got := unpack(raw)) is not None and got[0]:
        key = hashlib.blake2b(got[0], digest_size=16).digest()
        if key in seen:
            return
        seen.add(key)
        raw, cut = got[0], cut or got[1]
    if cut:
        del raw, got
        yield from ((s, True) for s in _pieces(first, len(seen)))
    elif seen and (s := raw.decode("utf-8", "replace")):
        yield s, False


def _replaced(layer: Layer, found: list[tuple[int, int, str]]) -> Layer | None:
    """The layer with regions replaced by what they encode; what stands between keeps its place."""
    if not found:
        return None
    parts, at, lo, hi, step, skip, done, size = [], [], [], [], [], [], 0, 0

    def add(s: str, *place: float) -> None:
        nonlocal size
        if s:
            parts.append(s)
            at.append(size)
            for column, x in zip((lo, hi, step, skip), place, strict=True):
                column.append(x)
            size += len(s)

    def keep(a: int, b: int) -> None:
        i = bisect_right(layer.at, a) - 1
        while a < b:
            end = min(b, layer.at[i + 1]) if i + 1 < len(layer.at) else b
            add(layer.text[a:end], layer.lo[i], layer.hi[i], layer.step[i], layer.skip[i] + a - layer.at[i])
            a, i = end, i + 1

    for a, b, s in found:
        keep(done, a)
        add(s, *layer.span(a, b), 0.0, 0)
        done = b
    keep(done, len(layer.text))
    return Layer("".join(parts), at, lo, hi, step, skip)


def _percent(layer: Layer) -> Layer | None:
    found = []
    if "%" in layer.text:
        for m in _PERCENT.finditer(layer.text):
            raw = bytes.fromhex(m.group().replace("%", ""))
            i = m.start()
            for c in raw.decode("utf-8", "replace"):
                n = 3 * len(c.encode()) if c != "�" else 3
                found.append((i, min(i + n, m.end()), c))
                i += n
                if i >= m.end():
                    break
    return _replaced(layer, found)


def _escapes(layer: Layer) -> Layer | None:
    found = []
    if "\\" in layer.text or "&#" in layer.text:
        for m in _ESCAPE.finditer(layer.text):
            n = int(m[6]) if m[6] else int(m[1] or m[2] or m[3] or m[4] or m[5], 16)
            if n < 0x110000 and not 0xD800 <= n < 0xE000:
                found.append((m.start(), m.end(), chr(n)))
    return _replaced(layer, found)


def _unwrapped(layer: Layer) -> Layer | None:
    """The layer without line ends inside base64 that is wrapped at one width; the first line may begin, and the last end, within its line."""
    found = []
    for m in _WRAPPED.finditer(layer.text) if "\n" in layer.text else ():
        ends = [(x.start() + m.start(), x.end() + m.start()) for x in _BREAK.finditer(m.group())]
        starts = [m.start(), *(b for _, b in ends)]
        sizes = [b - a for a, b in zip(starts, [*(a for a, _ in ends), m.end()], strict=True)]
        for i, (a, b) in enumerate(ends):
            # The width is that of the line before the break, or, if other characters stand before the run, that of the line after it.
            if sizes[i] >= 16 and (sizes[i + 1] <= sizes[i] or i == 0) or i == 0 and sizes[1] >= 16:
                found.append((a, b, ""))
    return _replaced(layer, found)


def _decoded(body: str) -> bytes:
    body = body[: len(body) - (len(body) % 4 == 1)].replace("-", "+").replace("_", "/")
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _base64(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    for m in _BASE64.finditer(layer.text):
        body = m.group().rstrip("=")
        if body.isalpha() and (body.islower() or body.istitle()):  # a plain word
            continue
        lo, hi = layer.span(m.start(), m.end())
        straight = hi - lo == m.end() - m.start()
        if len(body) % 4 != 1:
            raw = _decoded(body)
            packed = False
            for s, cut in _inflate(raw):
                packed = True
                yield Layer(s, [0], [lo], [hi], [0.0], [0]), cut
            if packed:
                continue
            if (s := _text(raw)) is not None:
                yield Layer(s, [0], [lo], [hi], [4 / 3 if straight and len(s) == len(raw) else 0.0], [0]), False
                continue
        for shift in range(4):
            raw, first = _decoded(body[shift:]), m.start() + shift

            def place(i: int, j: int) -> tuple[int, int]:
                return layer.span(first + i // 3 * 4, min(first - (-j // 3 * 4), m.end()))

            for x in _PACKED.finditer(raw):
                for s, cut in _inflate(raw[x.start() :]):
                    yield Layer(s, [0], *([y] for y in place(x.start(), len(raw))), [0.0], [0]), cut
            for x in _STRETCH.finditer(raw):
                s = x.group().decode("utf-8", "replace")
                fine = straight and len(s) == x.end() - x.start()
                yield Layer(s, [0], *([y] for y in place(*x.span())), [4 / 3 if fine else 0.0], [x.start() % 3]), False


def _opened(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    """The layers directly inside."""
    for f in (_percent, _escapes, _unwrapped):
        if (new := f(layer)) is not None:
            yield new, False
    yield from _base64(layer)


def _place(text: str, lo: int, hi: int) -> tuple[bytes, int, int]:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), lo, hi


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, bool]:
    """(base spans, all spans, layers opened, whether a layer was so large that it was scanned in pieces)."""
    return search(text)[:4]


def search(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, bool, list[tuple[int, int]]]:
    """What ``scan`` gives, and the regions that encode layers scanned in pieces."""
    base = base_spans(text)
    every, seen, cut, regions = set(base), {_place(text, 0, len(text))}, False, set()
    work = [_opened(Layer(text, [0], [0], [len(text)], [1.0], [0]))]
    while work:
        # One layer of each level at a time is held, so that the pieces of a large layer follow one another.
        if (got := next(work[-1], None)) is None:
            work.pop()
            continue
        new, short = got
        if short:
            cut = True
            regions.add((new.lo[0], new.hi[-1]))
        if (place := _place(new.text, new.lo[0], new.hi[-1])) not in seen:
            seen.add(place)
            for a, kind, b in base_spans(new.text):
                lo, hi = new.span(a, b)
                every.add((lo, kind, hi))
            work.append(_opened(new))
    return base, sorted(every), len(seen) - 1, cut, sorted(regions)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_layers", pa.int64()), ("cut", pa.bool_())])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base counts, digest of the base spans, all spans, layers opened, whether a layer was so large that it was scanned in pieces."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {f.name: [] for f in _SCHEMA}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            base, every, layers, cut = scan(text.as_py() or "")
            kinds = [k for _, k, _ in base]
            out["doc_id"].append(doc)
            for i, k in enumerate(KINDS):
                out[f"n_{k}"].append(kinds.count(i))
            out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
            out["spans"].append(written(every))
            out["n_layers"].append(layers)
            out["cut"].append(cut)
        yield out

    ddl = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, cut boolean"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(K.mapper(rows, _SCHEMA), ddl)


def mask(text: str | None, token: str = "[SECRET]") -> str | None:
    """The text with every span, inner layers' too, and every region of a layer scanned in pieces replaced; overlapping spans are replaced as one."""
    if not text:
        return text
    parts, done = [], 0
    _, spans, _, _, regions = search(text)
    for a, b in sorted([*((a, b) for a, _, b in spans), *regions]):
        if a >= done:
            parts += [text[done:a], token]
        done = max(done, b)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", token: str = "[SECRET]") -> DataFrame:
    """``docs``, same columns, with secrets replaced in the text and the length (if there is such a column) counted anew."""
    cols = docs.columns
    at = cols.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.released(batches):
            clean = [mask(t.as_py(), token) for t in batch.column(at)]
            arrays = list(batch.columns)
            arrays[at] = pa.array(clean, batch.schema.field(at).type)
            if length_col in cols:
                i = cols.index(length_col)
                arrays[i] = pa.array([None if t is None else len(t) for t in clean], batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(arrays, names=cols)

    return docs.mapInArrow(rows, docs.schema)
