"""Secret scans with a recursive decoding worklist.

Each text is scanned with the base patterns.  Then its encoded regions (URL percent runs, Unicode and character-entity
escapes, base64 runs, and gzip, zlib or bzip2 data inside base64) are unwrapped one layer at a time: a decoded layer is scanned
and put on the worklist itself, until no layer is new.  A layer already seen, by its hash, is not taken up again, so
cycles end.  Every layer carries, for each of its characters, the span of the original text that it came from; what is
found inside is reported at that span.

Base matches are leftmost and non-overlapping per kind, judged on the original text; deeper findings are only added.

Escapes are unwrapped where they are: a layer holds the stretch around them up to the next characters that no finding, no
escape and no base64 line can hold, not a copy of the text, and its span map is a list of evenly spaced stretches.  An escape of the
sign that begins escapes of its own kind (%2541, &amp;lt;, \\u005cu0041) is a layer like others; from eight in a row on all are unwrapped
in one step, so such nesting takes time in proportion to its length.

Base64 runs are read line by line and over line breaks, from each of four places on; what they give need not be clean text.

Compressed data is read as a stream, whatever it gives, all its members after each other; what it gives is scanned in windows
that overlap, as all of it stands for one span of the text.  So memory is bounded by the windows of the layers in hand.

Nesting ends by itself as every decoding is shorter than its source, save for decompression: compressed data inside compressed
data is opened until it is no longer new, or ``STREAMS`` deep where it is too large (``SMALL``) to be known again.

Defined results: a null text is empty; an empty text has no spans; texts of any length are scanned whole, one at a time; repeated rows
and rows without a doc_id are scanned each; an empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import html
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame

from . import _store
from ._words import chunks
from ._workers import lean

KINDS = ("assign", "access", "hex")
#: Bytes of compressed data read at a time and of a layer known by its hash; streamed layers inside each other.
CHUNK, SMALL, STREAMS = 1 << 12, 1 << 20, 200
#: Characters of a decompressed layer scanned at a time, and shared by two such windows.
WINDOW, OVERLAP = 1 << 20, 1 << 16
#: Characters of base64 that show whether compressed data begins there.
PROBE = 1 << 13
# The base patterns.  The runs of access and hex are maximal, so their least lengths can stand in the pattern.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)

#: Escapes; from eight escapes of their own first sign in between on, with these.
URL = re.compile(r"%(?:(?:25){8,})?[0-9A-Fa-f]{2}")
ESCAPE = re.compile(
    r"\\(?:(?:u005[cC]|x5[cC]){8,})?(?:u\{[0-9A-Fa-f]{1,6}\}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|x[0-9A-Fa-f]{2})"
    r"|&(?:(?:amp;){8,})?(?:#[xX][0-9A-Fa-f]{1,6};|#[0-9]{1,7};|(?:quot|amp|apos|lt|gt|equals|colon);)"
)
#: What findings, escapes and base64 lines are made of.
_STRETCH = re.compile(r"""[A-Za-z0-9+/_.=\-"' :\r\n\t>\\&;#{}%]{12,}""")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
#: The same over several lines; each goes on to the end of its line or of the data.
WRAPPED = re.compile(r"""(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\t ]*\r?\n[\t >]*[A-Za-z0-9+/_-]++(?==|[\t ]*(?:[\r\n"'`<,;)\]}]|\Z)))++={0,2}""")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: Bytes that findings are made of, zero, and others.
_MADE_OF = bytes(1 if x in b"\t\r\n" or 0x20 <= x < 0x7F else 0 if x == 0 else 2 for x in range(256))
#: What every finding needs, and base64 text of compressed data.
_ENOUGH = re.compile(r"[\t\r\n\x20-\x7e]{12}")
_PACKED = re.compile(r"H4sI|Qlpo|eJ[w-z]|eAE|eF4|eN[o-r]")
_OPEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=\r\n"

Span = tuple[str, int, int]


def _wide(raw: bytes) -> bool:
    """Whether bytes may hold a finding in two bytes a character."""
    made = raw.translate(_MADE_OF)
    return b"\1\0" * 12 in made or b"\0\1" * 12 in made


def _likely(raw: bytes) -> bool:
    return b"\1" * 12 in raw.translate(_MADE_OF) or _wide(raw)


def base_spans(text: str) -> list[Span]:
    """The base findings of one text, by start, then kind as listed."""
    out = []
    if _KEYWORD.search(text):
        out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return ordered(out)


def ordered(spans) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Layer:
    """A text and, for each of its characters, the span of the original text that it came from.

    ``span``: one for all.  Else stretches in order: from place ``at[i]`` on, each character came from ``width[i]`` characters of
    the original, the first of them at ``source[i]``.
    """

    __slots__ = ("at", "source", "span", "text", "width")

    def __init__(self, text: str, at=(0,), source=(0,), width=(1,), span: tuple[int, int] | None = None):
        self.text, self.at, self.source, self.width, self.span = text, at, source, width, span

    def char(self, k: int) -> tuple[int, int]:
        i = bisect_right(self.at, k) - 1
        start = self.source[i] + (k - self.at[i]) * self.width[i]
        return start, start + self.width[i]

    def mapped(self, start: int, end: int) -> tuple[int, int]:
        return self.span or (self.char(start)[0], self.char(end - 1)[1])

    def place(self) -> tuple[int, int]:
        return self.mapped(0, len(self.text)) if self.text else (0, 0)


class _Copy:
    """A layer in the making: stretches of another one, as they are or replaced."""

    def __init__(self, layer: Layer):
        self.layer, self.pieces, self.n, self.changed = layer, [], 0, False
        self.at, self.source, self.width = array("q"), array("q"), array("q")

    def _add(self, start: int, width: int, n: int) -> None:
        """``n`` more characters, each of ``width`` of the original."""
        at, source, widths = self.at, self.source, self.width
        if not (at and widths[-1] == width and source[-1] + (self.n - at[-1]) * width == start):
            at.append(self.n)
            source.append(start)
            widths.append(width)
        self.n += n

    def keep(self, lo: int, hi: int) -> None:
        if lo >= hi:
            return
        own = self.layer
        self.pieces.append(own.text[lo:hi])
        i = 0 if own.span else bisect_right(own.at, lo) - 1
        while not own.span and lo < hi:
            end = min(hi, own.at[i + 1]) if i + 1 < len(own.at) else hi
            self._add(own.source[i] + (lo - own.at[i]) * own.width[i], own.width[i], end - lo)
            lo, i = end, i + 1

    def put(self, char: str, lo: int, hi: int) -> None:
        """One character instead of those of lo..hi."""
        self.pieces.append(char)
        self.changed = True
        if not self.layer.span:
            a, b = self.layer.mapped(lo, hi)
            self._add(a, b - a, 1)

    def done(self) -> Layer | None:
        if not self.changed:
            return None
        text = "".join(self.pieces)
        return Layer(text, span=self.layer.span) if self.layer.span else Layer(text, self.at, self.source, self.width)


def _decode_urls(text: str, lo: int, hi: int, out: _Copy) -> None:
    """Percent bytes as UTF-8; bytes that are no UTF-8 stay, but for the outermost sign of nested ones."""
    held: list[tuple[int, int, int]] = []  # byte, start, end of units that may be one character

    def settle(end: bool) -> None:
        while held:
            x = held[0][0]
            n = 1 if x < 0x80 else 2 if x >> 5 == 6 else 3 if x >> 4 == 14 else 4 if x >> 3 == 30 else 0
            if n > len(held) and not end and all(y >> 6 == 2 for y, _, _ in held[1:]):
                return
            try:
                char = bytes(y for y, _, _ in held[:n]).decode() if 0 < n <= len(held) else ""
            except UnicodeDecodeError:
                char = ""
            _, a, b = held[0]
            if char:
                out.put(char, a, held[n - 1][2])
                del held[:n]
                continue
            if b - a > 3:
                out.put("%", a, a + 3)
                a += 3
            out.keep(a, b)
            del held[0]

    at = lo
    for m in URL.finditer(text, lo, hi):
        if m.start() != at:
            settle(True)
            out.keep(at, m.start())
        at = m.end()
        held.append((int(text[at - 2 : at], 16), m.start(), at))
        settle(False)
    settle(True)
    out.keep(at, hi)


def _decode_escapes(text: str, lo: int, hi: int, out: _Copy) -> None:
    """Unicode and character-entity escapes; those that stand for no character stay, but for the outermost sign of nested ones."""
    at, high = lo, None  # high: (code, start, end) of a first surrogate

    def literal(a: int, b: int, unit: str) -> None:
        first = re.match(r"\\(?:u005[cC]|x5[cC])|&amp;", unit)
        if first and first.end() < len(unit):
            out.put(unit[0], a, a + first.end())
            a += first.end()
        out.keep(a, b)

    for m in ESCAPE.finditer(text, lo, hi):
        a, b, unit = m.start(), m.end(), m[0]
        if high and (a != at or unit[1] != "u"):
            literal(*high[1:])
            high = None
        out.keep(at, a)
        at = b
        if unit[0] == "&":
            char = html.unescape("&" + unit[1:-1].rpartition(";")[2] + ";")
            if len(char) == 1:
                out.put(char, a, b)
            else:
                literal(a, b, unit)
            continue
        code = int(re.search(r"(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))\Z", unit)[0].strip("uUx{}"), 16)
        if high and 0xDC00 <= code < 0xE000:
            out.put(chr(0x10000 + ((high[0] - 0xD800) << 10) + (code - 0xDC00)), high[1], b)
            high = None
            continue
        if high:
            literal(*high[1:])
            high = None
        if 0xD800 <= code < 0xDC00:
            high = (code, a, b, unit)
        elif code < 0x110000 and not 0xDC00 <= code < 0xE000:
            out.put(chr(code), a, b)
        else:
            literal(a, b, unit)
    if high:
        literal(*high[1:])
    out.keep(at, hi)


def _unescaped(layer: Layer, sign: re.Pattern, decode: Callable[[str, int, int, _Copy], None]) -> Iterator[Layer]:
    """The stretches of a layer that hold such escapes, unwrapped."""
    for m in _STRETCH.finditer(layer.text):
        if sign.search(layer.text, m.start(), m.end()):
            made = _Copy(layer)
            decode(layer.text, m.start(), m.end(), made)
            if more := made.done():
                yield more


class _Plain(Exception):
    """What looked compressed is not: the bytes read so far."""


def _opener(head: bytes):
    if head[:2] == b"\x1f\x8b" or (head[:1] == b"\x78" and len(head) > 1 and not (head[0] << 8 | head[1]) % 31):
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if head[:3] == b"BZh" else None


def _members(parts: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed data gives, member after member, up to its first error; then what follows the members."""
    box, eaten, gave = None, b"", False
    for data in parts:
        eaten = b"" if gave else eaten + data
        more = True
        while data or more:
            if box is None:
                while len(data) < 3 and (rest := next(parts, b"")):
                    data += rest
                box = _opener(data)
                if box is None:
                    yield data
                    yield from parts
                    return
            try:
                out = box.decompress(data, SMALL)
            except (zlib.error, OSError, EOFError, ValueError) as e:
                if not gave:
                    raise _Plain(eaten) from e
                return
            if out:
                gave = True
                yield out
            if box.eof:
                data, box, more, gave = box.unused_data, None, False, True
            elif isinstance(box, bz2.BZ2Decompressor):
                data, more = b"", not box.needs_input
            else:
                data = box.unconsumed_tail
                more = len(out) == SMALL


def _cut(parts) -> Iterator[bytes]:
    return (p[i : i + CHUNK] for p in parts for i in range(0, len(p), CHUNK))


def _opened(parts: Iterator[bytes], deep: int = 0) -> Iterator[bytes]:
    """The bytes inside all compressed layers around them."""
    seen = set()
    while True:
        held, n = [], 0
        for p in parts:
            held.append(p)
            n += len(p)
            if n > SMALL:
                break
        head = b"".join(held)
        if n > SMALL or _opener(head) is None or (key := hashlib.blake2b(head, digest_size=16).digest()) in seen:
            break
        seen.add(key)
        inner = _members(_cut([head]))
        try:
            first = next(inner, b"")
        except _Plain:
            break
        parts = chain([first], inner)
    if n > SMALL and deep < STREAMS and _opener(head):
        rest = _cut(chain([head], parts))
        inner = _members(rest)
        try:
            first = next(inner, b"")
        except _Plain as e:
            yield e.args[0]
            yield from rest
        else:
            yield from _opened(chain([first], inner), deep + 1)
        return
    yield head
    yield from parts


def _windows(parts: Iterator[bytes], span: tuple[int, int], codec: str = "utf-8") -> Iterator[Layer]:
    """The bytes as text, in overlapping windows; what is no text in between is replaced."""
    decoder, text = codecs.getincrementaldecoder(codec)("replace"), ""
    more: list[str] = []  # what continues a run that is kept whole: it is looked at once, when the run ends
    for p in parts:
        new = decoder.decode(p)
        if more and not new.rstrip(_OPEN):
            more.append(new)
            continue
        text, more = "".join([text, *more, new]), []
        if len(text) < WINDOW:
            continue
        if " " * 64 in text:
            text = re.sub(" {64,}", " ", text)  # any number of spaces is alike to the patterns
        cut, run = len(text) - OVERLAP, len(text.rstrip(_OPEN))
        packed = run < cut and _PACKED.search(text, run, run + 256)  # compressed data that is not cut
        if cut <= 0 or (packed and not run):
            more = [""]
            continue
        if _ENOUGH.search(text):
            yield Layer(text, span=span)
        text = text[run if packed else cut :]
    text = "".join([text, *more, decoder.decode(b"", True)])
    if _ENOUGH.search(text):
        yield Layer(text, span=span)


def _read(raw: bytes, span: tuple[int, int]) -> Iterator[Layer]:
    yield from _views(lambda: _opened(iter([raw])), span)
    if raw[:1] == b"x" and _opener(raw):  # text may begin like compressed data
        yield from _views(lambda: iter([raw]), span)


def _views(parts: Callable[[], Iterator[bytes]], span: tuple[int, int]) -> Iterator[Layer]:
    """The bytes as UTF-8 and, if some are two to a character (in either order, from any place on), every second byte."""
    wide = False

    def watched() -> Iterator[bytes]:
        nonlocal wide
        tail = b""
        for p in parts():
            wide = wide or _wide(tail + p)
            tail = (tail + p)[-24:]
            yield p

    yield from _windows(watched(), span)
    for k in (0, 1) if wide else ():
        yield from _windows(_strided(parts(), k), span, "latin-1")


def _strided(parts: Iterator[bytes], k: int) -> Iterator[bytes]:
    for p in parts:
        yield p[k::2]
        k = (k - len(p)) % 2


def _opens(raw: bytes) -> bool:
    """Whether bytes begin like compressed data and do not fail at once."""
    if _opener(raw) is None:
        return False
    try:
        next(_members(_cut([raw])), b"")
    except _Plain:
        return False
    return True


def _decoded(run: str, lines: list[int] = ()) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of what base64 text may stand for: from each of its first four places, as other characters may have
    joined it in front, and from where compressed data begins.  Where it only seems to, by a few signs, there is nothing that the
    first four places do not give."""
    run = run.rstrip("=")
    plain = run.replace("-", "+").replace("_", "/")
    places = {0, 1, 2, 3} | {m.start() for m in _PACKED.finditer(run) if m[0] in ("H4sI", "Qlpo") or run[m.start() - 1 : m.start()] in ("/", "_", "-", "+")}
    places |= {k for k in lines if _PACKED.match(run, k)}
    for k in sorted(places):
        if k > 3 and not _opens(base64.b64decode(plain[k : k + min(len(plain) - k, PROBE) // 4 * 4])):
            continue
        n = len(plain) - k
        raw = base64.b64decode(plain[k : len(plain) - (n % 4 == 1)] + "=" * (-n % 4 if n % 4 != 1 else 0))
        if _opener(raw) or _likely(raw):
            yield k, raw


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    for m in BASE64.finditer(layer.text):
        for k, raw in _decoded(m.group()):
            yield from _read(raw, layer.mapped(m.start() + k, m.end()))
    if "\n" not in layer.text:
        return
    for m in WRAPPED.finditer(layer.text):
        lines = [(x.start() + m.start(), x[0]) for x in _LINE.finditer(m[0])]
        run, starts = "".join(x for _, x in lines), list(accumulate((len(x) for _, x in lines), initial=0))
        for k, raw in _decoded(run, starts[1:-1]):
            i = bisect_right(starts, k) - 1
            yield from _read(raw, layer.mapped(lines[i][0] + k - starts[i], m.end()))


def unwrap(layer: Layer) -> Iterator[Layer]:
    text = layer.text
    if "%" in text:
        yield from _unescaped(layer, URL, _decode_urls)
    if "\\" in text or "&" in text:
        yield from _unescaped(layer, ESCAPE, _decode_escapes)
    yield from _base64_layers(layer)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a whole text."""
    base = base_spans(text)
    found = set(base)
    seen: set[bytes] = set()
    work = [unwrap(Layer(text))]
    while work:
        more = next(work[-1], None)
        if more is None:
            work.pop()
            continue
        # The same words decoded at another place are another finding: the place belongs to the key.
        key = hashlib.blake2b(("{}:{}:".format(*more.place()) + more.text).encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if key in seen:
            continue
        seen.add(key)
        for kind, a, b in base_spans(more.text):
            found.add((kind, *more.mapped(a, b)))
        work.append(unwrap(more))
    return base, ordered(found)


def spell(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every maximal union of spans replaced."""
    out, at = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every document; offsets are code points of the original text, ends exclusive."""
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (c for batch in batches for c in chunks(batch, size=1 << 22)):
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                base, spans = scan(text)
                rows.append((doc_id, *(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(spell(base).encode()).hexdigest(), spell(spans), len(spans) - len(base)))
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return _store.id_text(docs).mapInArrow(run, FOUND)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All columns of ``docs`` with every found span of ``text_col`` replaced by ``mark``; a null text stays null."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(docs.schema)

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = schema.get_field_index(text_col)
        for b in (c for batch in batches for c in chunks(batch, at, 1 << 22)):
            texts = [t and (redact(t, s, mark) if (s := scan(t)[1]) else t) for t in b.column(at).to_pylist()]
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
