"""Secret scans through nested encodings.

The patterns are searched in the text itself and in every layer that can be unwrapped from it: percent and Unicode
escapes (line by line, as no pattern spans a line end), base64, in one line or wrapped over several, and gzip, zlib or
bzip2 data within base64. Base64 is read at all four alignments, so characters of its alphabet in front do not hide it, and
UTF-16 within it is read too. A worklist goes on until no layer gives a new one; a layer seen before is not opened again, so cycles end. Every character of a
layer remembers which characters of the original text it was made of, and a find in a layer is reported as their span.

Compressed data is expanded through all its members in blocks of ``most_bytes``, which bounds the memory that decompression bombs
take. A block ends at a line end that parts no wrapped base64. Bytes that are not UTF-8 are read as Latin-1.

Defined results: null text is empty text, without finds. Rows are scanned each, repeated rows too. A layer is counted in
``n_unopened`` when it is searched whole, but a line (or wrapped base64) in it is longer than ``most_bytes``, so encodings
within that line may be cut, or when data compressed once more does not fit one block; redaction takes its whole span out.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, slices

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
_ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 that goes on over line ends: lines that are wholly base64, the last piece of the line before and the first of the one after.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++")
_PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
_PRINTABLE = bytes(range(32, 127)) + b"\t\n\r"
#: The shortest find has 12 characters: bytes with so many readable ones in a row, also as UTF-16, are followed.
_READABLE = re.compile(rb"[\x20-\x7e\t\n\r]{12,}")
_WIDE = re.compile(rb"(?:[\x20-\x7e\t\n\r]\0){12,}")
#: How base64 of gzip, bzip2 and zlib data begins.
_HEADER = re.compile(r"H4sI|Qlpo|eJ[w-z]|eN[o-r]|eA[E-H]|eF[4-7]")

MOST_BYTES = 16 << 20
#: Compressed bytes given to a decompressor at a time, and what the pieces of a line beyond ``most_bytes`` have in common.
_FED, _OVERLAP = 1 << 16, 1 << 16

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The finds in ``text`` itself: leftmost, not overlapping within a kind, too short ones dropped afterwards."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run's first match is the whole run, so the length can stand in the pattern.
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return ordered(found)


def ordered(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Layer:
    """A text and, for each character, the span of the original text that it was made of (``None``: itself)."""

    __slots__ = ("text", "starts", "ends", "made")

    def __init__(self, text: str, starts: list[int], ends: list[int], made: list[bool]):
        self.text, self.starts, self.ends, self.made = text, starts, ends, made


def _unescaped(line: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """``line`` with every run of escapes decoded; characters that stand as they are keep their spans."""
    text, starts, ends, made, at, changed = [], [], [], [], 0, False

    def keep(a: int, b: int) -> None:
        text.append(line.text[a:b])
        starts.extend(line.starts[a:b])
        ends.extend(line.ends[a:b])
        made.extend(line.made[a:b])

    runs = re.compile(f"(?:{pattern.pattern})+")
    for run in runs.finditer(line.text):
        got = decode([m.span() for m in pattern.finditer(line.text, run.start(), run.end())], line.text)
        if not got:
            continue
        keep(at, run.start())
        for chars, a, b in got:
            text.append(chars)
            starts.extend([line.starts[a]] * len(chars))
            ends.extend([line.ends[b - 1]] * len(chars))
            made.extend([True] * len(chars))
        at, changed = run.end(), True
    if not changed:
        return None
    keep(at, len(line.text))
    return Layer("".join(text), starts, ends, made)


def _percent(spans: list[tuple[int, int]], text: str) -> list[tuple[str, int, int]]:
    """Characters of a run of percent escapes, read as UTF-8 (else as Latin-1), with the escapes each takes."""
    raw = bytes(int(text[a + 1:b], 16) for a, b in spans)
    try:
        chars = raw.decode()
    except UnicodeDecodeError:
        chars = raw.decode("latin-1")
        return [(c, *span) for c, span in zip(chars, spans)]
    out, at = [], 0
    for c in chars:
        n = len(c.encode())
        out.append((c, spans[at][0], spans[at + n - 1][1]))
        at += n
    return out


def _escapes(spans: list[tuple[int, int]], text: str) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    codes = []
    for a, b in spans:
        body = text[a + 2:b].strip("{};")
        codes.append(int(body) if text[a] == "&" and body[0] not in "xX" else int(body.lstrip("xX"), 16))
    i = 0
    while i < len(codes):
        code, (a, b) = codes[i], spans[i]
        if 0xD800 <= code < 0xDC00 and i + 1 < len(codes) and 0xDC00 <= codes[i + 1] < 0xE000:
            code, b, i = 0x10000 + (code - 0xD800 << 10) + codes[i + 1] - 0xDC00, spans[i + 1][1], i + 1
        out.append((chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�", a, b))
        i += 1
    return out


class _Same:
    """One value for each of ``n`` characters."""

    __slots__ = ("value", "n")

    def __init__(self, value, n: int):
        self.value, self.n = value, n

    def __len__(self) -> int:
        return self.n

    def __iter__(self):
        return repeat(self.value, self.n)

    def __getitem__(self, i):
        return _Same(self.value, len(range(*i.indices(self.n)))) if isinstance(i, slice) else self.value


class _Placed:
    """For each of ``n`` characters of ``step`` bytes from byte ``begin`` on, the value of the base64 character that starts (or
    with ``more`` ends) what it was made of; ``first`` and ``last`` are the places of the base64 in its layer. Nothing is
    stored for a character, so base64 of any length is mapped."""

    __slots__ = ("values", "first", "last", "begin", "step", "more", "n")

    def __init__(self, values, first: int, last: int, begin: int, step: int, more: int, n: int):
        self.values, self.first, self.last, self.begin, self.step, self.more, self.n = values, first, last, begin, step, more, n

    def __len__(self) -> int:
        return self.n

    def __iter__(self):
        return (self[i] for i in range(self.n))

    def __getitem__(self, i):
        if isinstance(i, slice):
            at = range(self.n)[i]
            return _Placed(self.values, self.first, self.last, self.begin + self.step * at.start, self.step * at.step, self.more, len(at))
        byte = self.begin + self.step * range(self.n)[i]
        return self.values[min(self.first + byte // 3 * 4 + self.more, self.last)]


def _opener(raw: bytes):
    """A decompressor for what begins with ``raw``, or None."""
    if raw[:2] == b"\x1f\x8b" or raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if raw[:3] == b"BZh" else None


def _expanded(raw: bytes, most: int) -> Iterator[bytes]:
    """The content of gzip, zlib or bzip2 data in blocks, member after member, then bytes that follow the last one. What is
    damaged is given as far as it can be read; nothing if it is no such data."""
    at = 0
    while opener := _opener(raw[at:at + 3]):
        began, given = at, False
        try:
            fed = b""
            while not opener.eof:
                if not fed and getattr(opener, "needs_input", True):
                    fed = raw[at:at + _FED]
                    at += len(fed)
                out = opener.decompress(fed, most)
                ended = not fed and not out and at >= len(raw)
                fed = getattr(opener, "unconsumed_tail", b"")
                if out:
                    given = True
                    yield out
                if ended:
                    break
        except (zlib.error, OSError, EOFError):
            if not given and not began:
                return
            at = began + 1  # what follows is read as it is
            break
        at -= len(opener.unused_data)
        while at < len(raw) and not raw[at]:
            at += 1
    if at and at < len(raw):
        yield raw[at:]


def _cut(held: bytes) -> tuple[int, int]:
    """Where a block ends and where the next one begins, at line ends and before the wrapped base64 that goes on over the end;
    (0, 0) if there is no such place."""
    stop = held.rfind(b"\n") + 1
    start = stop
    while start:
        before = held.rfind(b"\n", 0, start - 1) + 1
        whole = _PIECE.fullmatch(held[before:start].decode("latin-1").strip())
        start = before
        if not whole:
            break
    return (stop, start) if start else (0, 0)


def _texts(raw: bytes, most: int, opened: frozenset = frozenset()) -> Iterator[tuple[str, bool]]:
    """The texts of ``raw``, expanded if it is compressed, each with whether anything in it may be cut."""

    def text(block: bytes) -> str:
        try:
            return block.decode()
        except UnicodeDecodeError:
            return block.decode("latin-1")

    key = hashlib.blake2b(raw, digest_size=16).digest()
    if key in opened:
        return
    held, cut, some = b"", False, False
    for block in _expanded(raw, most):
        some = True
        held += block
        while len(held) > most:
            stop, start = _cut(held)
            hard = not stop
            if hard:
                stop, start = len(held), max(len(held) - min(_OVERLAP, most // 2), 1)
            yield text(held[:stop]), hard or not cut and _opener(held[:3]) is not None
            held, cut = held[start:], True
            if hard:
                break
    if not some:
        yield text(raw), False
    elif not cut and _opener(held[:3]):
        yield from _texts(held, most, opened | {key})
    elif held:
        yield text(held), False


def _unwrapped(layer: Layer, most: int) -> Iterator[Layer | tuple[int, int]]:
    """Layers one step below; a span for one in which something may be cut."""
    text = layer.text
    for mark, pattern, decode in (("%", _PERCENT, _percent), ("\\", _ESCAPE, _escapes), ("&#", _ESCAPE, _escapes)):
        if mark not in text or not pattern.search(text):
            continue
        start = 0
        for line in text.split("\n"):
            stop = start + len(line)
            if mark in line:
                part = Layer(line, layer.starts[start:stop], layer.ends[start:stop], layer.made[start:stop])
                if below := _unescaped(part, pattern, decode):
                    yield below
            start = stop + 1
    for m in _BASE64.finditer(text):
        body = m.group().rstrip("=").translate({45: 43, 95: 47})
        start, end = layer.starts[m.start()], layer.ends[m.end() - 1]
        for shift in range(4):
            raw = _decoded(body[shift:])
            if not raw:
                break

            def piece(begin: int, step: int, inner: str, shift: int = shift) -> Layer:
                """Characters of ``step`` bytes each from byte ``begin`` on, with the base64 characters that they were made of."""
                first, last, n = m.start() + shift, m.end() - 1, len(inner)
                starts = _Placed(layer.starts, first, last, begin, step, 0, n)
                return Layer(inner, starts, _Placed(layer.ends, first, last, begin, step, 3 + (step > 1), n), _Same(True, n))

            if not shift and not raw.translate(None, _PRINTABLE):
                yield piece(0, 1, raw.decode("ascii"))
                break
            if not shift and not _opener(raw[:3]):
                # Read as Latin-1, every byte is a character of its own; finds are ASCII in either reading.
                yield piece(0, 1, raw.decode("latin-1"))
            elif not shift:
                for inner, cut in _texts(raw, most):
                    if cut:
                        yield start, end
                    n = len(inner)
                    yield Layer(inner, _Same(start, n), _Same(end, n), _Same(True, n))
            else:
                # Base64 behind characters that look like it, such as those of a path.
                for run in _READABLE.finditer(raw):
                    yield piece(run.start(), 1, run.group().decode("ascii"))
            for run in _WIDE.finditer(raw):
                yield piece(run.start(), 2, run.group().replace(b"\0", b"").decode("ascii"))
        for head in _HEADER.finditer(body, 1):
            raw = _decoded(body[head.start():])
            if raw and next(_expanded(raw, most), None):
                begin = layer.starts[m.start() + head.start()]
                for inner, cut in _texts(raw, most):
                    if cut:
                        yield begin, end
                    n = len(inner)
                    yield Layer(inner, _Same(begin, n), _Same(end, n), _Same(True, n))


def _decoded(body: str) -> bytes | None:
    """What base64 without its padding stands for; a last character that completes no byte counts for nothing."""
    body = body[:len(body) - (len(body) % 4 == 1)]
    if len(body) < 15:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def _joined_lines(layer: Layer) -> Iterator[Layer]:
    """Wrapped base64 of ``layer`` without its line ends: each run as a whole, and its parts of equally long lines with a shorter
    line after and another one before, as words before and behind may look like base64."""
    for run in _WRAPPED.finditer(layer.text):
        if run.end() - run.start() < 17:
            continue
        pieces = [m.span() for m in _PIECE.finditer(layer.text, run.start(), run.end())]
        n = len(pieces)
        chosen = {(a, b) for a in (0, 1) for b in (n - 2, n - 1)}
        start = 0
        for i in range(1, n + 1):
            if i == n or pieces[i][1] - pieces[i][0] != pieces[start][1] - pieces[start][0]:
                chosen |= {(a, b) for a in (start - 1, start) for b in (i - 1, i)}
                start = i
        for a, b in sorted(chosen):
            if 0 <= a < b < n and sum(stop - begin for begin, stop in pieces[a:b + 1]) >= 16:
                starts, ends = array("q"), array("q")
                for begin, stop in pieces[a:b + 1]:
                    starts.extend(layer.starts[begin:stop])
                    ends.extend(layer.ends[begin:stop])
                text = "".join(layer.text[begin:stop] for begin, stop in pieces[a:b + 1])
                yield Layer(text, starts, ends, [False] * len(text))


def _scan(text: str, most: int) -> tuple[list[Span], list[Span], list[tuple[int, int]]]:
    """(base finds, all finds, spans of layers in which something may be cut)."""
    base = base_spans(text)
    found, unopened = set(base), set()
    if not ("%" in text or "\\" in text or "&#" in text or _BASE64.search(text) or _WRAPPED.search(text)):
        return base, base, []
    seen = set()

    def first() -> Iterator[Layer]:
        # Only lines with something to unwrap are followed, so a long text needs no table of all its characters.
        start = 0
        for line in text.split("\n"):
            if _PERCENT.search(line) or _ESCAPE.search(line) or _BASE64.search(line):
                at = range(start, start + len(line))
                yield Layer(line, at, range(start + 1, start + len(line) + 1), [False] * len(line))
            start += len(line) + 1
        yield from _joined_lines(Layer(text, range(len(text)), range(1, len(text) + 1), []))

    def below(parent: Layer) -> Iterator[Layer]:
        """New layers below, each followed by its wrapped base64."""
        for layer in _unwrapped(parent, most):
            if isinstance(layer, tuple):
                unopened.add(layer)
                continue
            if not layer.text:
                continue
            key = hashlib.blake2b(
                f"{layer.starts[0]}:{layer.ends[-1]}:{layer.text}".encode("utf-8", "replace"), digest_size=16).digest()
            if key in seen:
                continue
            seen.add(key)
            for kind, a, b in base_spans(layer.text):
                if any(layer.made[a:b]):
                    found.add((kind, layer.starts[a], max(layer.ends[a:b])))
            yield layer
            yield from _joined_lines(layer)

    # Layers are made when they are needed, so of each depth one block is held.
    work = [first()]
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
        else:
            work.append(below(layer))
    return base, ordered(found), sorted(unopened)


def scan(text: str, most_bytes: int = MOST_BYTES) -> tuple[list[Span], list[Span], int]:
    """(base finds, all finds, number of layers in which something may be cut)."""
    base, found, unopened = _scan(text, most_bytes)
    return base, found, len(unopened)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """Every document's finds as ``base`` and ``spans`` (arrays of kind, start, end) and ``n_unopened``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            base, spans, unopened = zip(*(scan(t or "", most_bytes) for t in part.column("text").to_pylist()))
            listed = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in column], kind)
                      for column in (base, spans)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *listed, pa.array(unopened, pa.int64())], names=["doc_id", "base", "spans", "n_unopened"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    element = "array<struct<kind:string,start:bigint,end:bigint>>"
    return map_batches(chosen, find, f"doc_id long, base {element}, spans {element}, n_unopened long")


def redact(text: str, most_bytes: int = MOST_BYTES) -> str:
    """``text`` with every find replaced by its kind in brackets, and layers in which something may be cut; overlapping ones
    are replaced together."""
    out, at = [], 0
    _, spans, unopened = _scan(text, most_bytes)
    spans = sorted([*spans, *(("unopened", *span) for span in unopened)], key=lambda s: s[1])
    i = 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[{kind}]"]
        at, i = end, i + 1
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars", most_bytes: int = MOST_BYTES) -> DataFrame:
    """``docs`` with the same columns, finds in ``text_col`` replaced and ``size_col`` (if there) counted anew."""
    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            columns = list(part.columns)
            texts = [None if t is None else redact(t, most_bytes) for t in part.column(at).to_pylist()]
            columns[at] = pa.array(texts, pa.string())
            if size_col in part.schema.names:
                i = part.schema.names.index(size_col)
                sizes = [old if t is None else len(t) for t, old in zip(texts, columns[i].to_pylist())]
                columns[i] = pa.array(sizes, columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return map_batches(docs, clean, docs.schema)


@register("op10_secret_scans")
def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(table(spark, sf_dir, "documents"))
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"),
        "n_unopened")
