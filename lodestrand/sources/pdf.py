"""Text, positions and bookmarks of PDF files, with the standard library alone.

Read are plain and Flate-compressed objects and object streams, the page tree, text-showing operators with their positions, and
outlines with explicit destinations.  Fonts with encodings of their own give their bytes; pictures give nothing (no OCR).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from itertools import groupby

_TOKEN = re.compile(rb"\s*(?:%[^\r\n]*\s*)*(<<|>>|\[|\]|\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|/[^\s<>\[\](){}/%]*|[^\s<>\[\](){}/%]+)", re.DOTALL)
_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.DOTALL)
_ESCAPED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Name(str):
    __slots__ = ()


@dataclass(frozen=True)
class Ref:
    number: int


@dataclass
class Page:
    height: float
    lines: list[tuple[float, str]] = field(default_factory=list)  # distance from the top, text


def _literal(raw: bytes) -> bytes:
    def one(m: re.Match) -> bytes:
        c = m[1]
        return bytes([int(c, 8) & 255]) if c[:1].isdigit() else b"" if c in (b"\n", b"\r", b"\r\n") else _ESCAPED.get(c, c)

    return re.sub(rb"\\([0-7]{1,3}|\r\n|.)", one, raw, flags=re.DOTALL)


def text_of(raw: bytes) -> str:
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")


def values(data: bytes):
    """The values and operators of PDF syntax, in order; operators are bytes."""
    stack: list[list] = [[]]
    for m in _TOKEN.finditer(data):
        t = m[1]
        if t in (b"<<", b"["):
            stack.append([])
        elif t in (b">>", b"]") and len(stack) > 1:
            items = stack.pop()
            stack[-1].append(dict(zip(items[::2], items[1::2], strict=False)) if t == b">>" else items)
        elif t[:1] == b"(":
            stack[-1].append(("text", _literal(t[1:-1])))
        elif t[:1] == b"<":
            digits = b"".join(t[1:-1].split())
            stack[-1].append(("text", bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())))
        elif t[:1] == b"/":
            stack[-1].append(Name(t[1:].decode("latin-1")))
        elif re.fullmatch(rb"[+-]?(?:\d+\.?\d*|\.\d+)", t):
            stack[-1].append(float(t) if b"." in t else int(t))
        elif t == b"R" and len(stack[-1]) > 1 and isinstance(stack[-1][-2], int):
            stack[-1][-2:] = [Ref(stack[-1][-2])]
        else:
            stack[-1].append({b"true": True, b"false": False, b"null": None}.get(t, t))
    return stack[0]


class Document:
    def __init__(self, data: bytes):
        self.raw: dict[int, tuple[object, bytes]] = {}
        self.trailer: dict = {}
        for m in _OBJECT.finditer(data):
            head, mark, body = m[3].partition(b"stream")
            parsed = values(head)
            own = parsed[0] if parsed else None
            self.raw[int(m[1])] = own, body.lstrip(b"\r").removeprefix(b"\n").rpartition(b"endstream")[0] if mark else b""
        for own, body in list(self.raw.values()):
            if isinstance(own, dict) and own.get("Type") == "ObjStm":
                self._unpack(own, self._plain(own, body))
        for m in re.finditer(rb"\btrailer\b", data):
            found = values(data[m.end() : m.end() + 4096].partition(b"startxref")[0])
            if found and isinstance(found[0], dict):
                self.trailer |= found[0]
        for own, _ in self.raw.values():
            if isinstance(own, dict) and own.get("Type") == "XRef":
                self.trailer = own | self.trailer
        self.root = self.get(self.trailer.get("Root")) or next((o for o, _ in self.raw.values() if isinstance(o, dict) and o.get("Type") == "Catalog"), {})
        self.refs = [r for r in self._leaves(self.root.get("Pages"))]
        if not self.refs:
            raise ValueError("no page in the PDF")

    def _plain(self, own: dict, body: bytes) -> bytes:
        kinds = self.get(own.get("Filter"))
        kinds = kinds if isinstance(kinds, list) else [kinds] if kinds else []
        for kind in kinds:
            if kind not in ("FlateDecode", "Fl"):
                return b""
            body = zlib.decompressobj().decompress(body)
        return body

    def _unpack(self, own: dict, body: bytes) -> None:
        first = own.get("First", 0)
        heads = [int(x) for x in body[:first].split()]
        starts = heads[1::2] + [len(body) - first]
        for number, a, b in zip(heads[::2], starts, starts[1:], strict=False):
            found = values(body[first + a : first + b])
            self.raw.setdefault(number, (found[0] if found else None, b""))

    def get(self, value):
        while isinstance(value, Ref):
            value = self.raw.get(value.number, (None, b""))[0]
        return value

    def _leaves(self, node, seen: frozenset = frozenset()):
        own = self.get(node)
        if not isinstance(own, dict) or (isinstance(node, Ref) and node.number in seen):
            return
        kids = self.get(own.get("Kids"))
        if kids is None:
            yield node
        for kid in kids or []:
            yield from self._leaves(kid, seen | ({node.number} if isinstance(node, Ref) else set()))

    def _inherited(self, page: dict, key: str):
        while page:
            if key in page:
                return self.get(page[key])
            page = self.get(page.get("Parent"))
        return None

    def pages(self) -> list[Page]:
        return [self._page(self.get(r)) for r in self.refs]

    def _page(self, own: dict) -> Page:
        box = self._inherited(own, "MediaBox") or [0, 0, 612, 792]
        out = Page(float(self.get(box[3])) - float(self.get(box[1])))
        parts = self.get(own.get("Contents"))
        refs = parts if isinstance(parts, list) else [own.get("Contents")]
        body = b"\n".join(self._plain(*self.raw[r.number]) for r in refs if isinstance(r, Ref) and r.number in self.raw)
        top, pieces, args = float(self.get(box[3])), [], []
        line, at, leading = [0.0, 0.0], [0.0, 0.0], 0.0
        for v in values(body):
            if not isinstance(v, bytes):
                args.append(v)
                continue
            if v == b"BT":
                line = [0.0, 0.0]
            elif v == b"Tm" and len(args) >= 6:
                line = [float(args[-2]), float(args[-1])]
            elif v in (b"Td", b"TD") and len(args) >= 2:
                line = [line[0] + args[-2], line[1] + args[-1]]
                leading = -args[-1] if v == b"TD" else leading
            elif v == b"TL" and args:
                leading = args[-1]
            elif v in (b"T*", b"'", b'"'):
                line = [line[0], line[1] - leading]
            if v in (b"Tj", b"'", b'"', b"TJ") and args:
                at = line
                shown = args[-1] if isinstance(args[-1], list) else [args[-1]]
                words = "".join(text_of(x[1]) if isinstance(x, tuple) else " " if isinstance(x, (int, float)) and x < -200 else "" for x in shown)
                pieces.append((round(top - at[1], 1), at[0], len(pieces), words))
            args = []
        for y, row in groupby(sorted(pieces), key=lambda p: p[0]):
            if words := " ".join("".join(p[3] if i == 0 or p[1] == 0 else " " + p[3] for i, p in enumerate(row)).split()):
                out.lines.append((y, words))
        return out

    def bookmarks(self) -> list[tuple[int, str, int, float]]:
        """(level, title, page from 1, distance from the top) in order."""
        heights, number = [p.height for p in self.pages()], {r.number: i for i, r in enumerate(self.refs) if isinstance(r, Ref)}
        out, seen = [], set()

        def walk(ref, level: int) -> None:
            while isinstance(ref, Ref) and ref.number not in seen:
                seen.add(ref.number)
                own = self.get(ref) or {}
                place = self.get(own.get("Dest")) or self.get((self.get(own.get("A")) or {}).get("D"))
                title = self.get(own.get("Title"))
                if isinstance(place, list) and isinstance(place[0], Ref) and place[0].number in number and isinstance(title, tuple):
                    page = number[place[0].number]
                    top = place[3] if len(place) > 3 and isinstance(place[3], (int, float)) else heights[page]
                    out.append((level, text_of(title[1]), page + 1, heights[page] - float(top)))
                walk(own.get("First"), level + 1)
                ref = own.get("Next")

        walk((self.get(self.root.get("Outlines")) or {}).get("First"), 1)
        return out


def markdown(data: bytes) -> str:
    """Every page's lines under its page mark."""
    pages = [f"<!-- page:{i} -->\n\n" + "\n".join(t for _, t in p.lines) for i, p in enumerate(Document(data).pages(), 1)]
    return "\n\n".join(p.rstrip() for p in pages)


def layout(data: bytes) -> dict:
    """What the extraction profiles read: lines and blocks with their places, bookmarks and the page height."""
    held = Document(data)
    pages = held.pages()
    blocks = [(i, y, t) for i, p in enumerate(pages, 1) for y, t in p.lines]
    return {"lines": [(i, t) for i, _, t in blocks], "blocks": blocks, "bookmarks": held.bookmarks(), "height": pages[0].height}
