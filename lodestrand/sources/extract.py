"""Canonical markdown from HTML, JSON, CSV, XML, DOCX and XLSX, with the standard library.

One dispatch per document runs in Arrow batches; a document that cannot be read becomes a row with an error, the rest go on.
"""

from __future__ import annotations

import csv
import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import pdf

# What is removed, what makes a block, and section names that end an article.
DROPPED = {"script", "style", "nav", "footer", "aside", "form", "noscript"}
BLOCKS = {"blockquote", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "p", "pre", "table"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ARTICLE_DROPPED = {"navbox", "navbar", "vertical-navbox", "authority-control", "mw-references-wrap", "reflist", "metadata", "noprint", "shortdescription", "ambox", "mbox-small", "sistersitebox", "portalbox", "catlinks", "mw-editsection"}
ARTICLE_END = {"bibliography", "citations", "external links", "further reading", "general references", "notes", "references", "see also", "sources", "ayrıca bakınız", "dipnotlar", "dış bağlantılar", "ileri okuma", "kaynaklar", "kaynakça", "konuyla ilgili yayınlar", "notlar"}


class Node:
    __slots__ = ("attrs", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))

    def text(self, skip: frozenset[str] = frozenset()) -> str:
        parts: list[str] = []
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                parts.append(n)
            elif n is self or n.tag not in skip:
                stack.extend(reversed(n.kids))
        return " ".join(" ".join(parts).split())

    def above(self) -> Iterator[Node]:
        n = self.parent
        while n is not None:
            yield n
            n = n.parent


class _Tree(HTMLParser):
    """A forgiving tree: an end tag closes the nearest open element of its name; p and li close themselves."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd") and self.at.tag == tag:
            self.at = self.at.parent
        elif self.at.tag == "p" and tag in BLOCKS | {"div", "ul", "ol", "dl", "section"}:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n is not self.root and n.tag != tag:
            n = n.parent
        if n is not self.root:
            self.at = n.parent

    def handle_data(self, data):
        self.at.kids.append(data)


def pipe_table(rows: list[list[str]]) -> str:
    """A markdown table; the first row is the header, short rows are filled up."""
    width = max(map(len, rows))
    lines = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])


def _table_rows(table: Node) -> list[list[str]]:
    rows = []
    for tr in table.walk():
        if tr.tag == "tr" and next(a for a in tr.above() if a.tag == "table") is table:
            cells = [c.text().replace("\\", "\\\\").replace("|", "\\|") for c in tr.walk() if c.tag in ("td", "th") and next(a for a in c.above() if a.tag == "tr") is tr]
            if cells:
                rows.append(cells)
    return rows


def _drop(root: Node, article: bool) -> None:
    for n in list(root.walk()):
        classes = set(n.attrs.get("class", "").split())
        gone = n.tag in DROPPED or (article and (classes & ARTICLE_DROPPED or n.attrs.get("role") == "navigation" or (n.tag == "sup" and "reference" in classes)))
        if gone and n.parent is not None:
            n.parent.kids.remove(n)


def _block(n: Node, root: Node) -> tuple[str, str] | None:
    """(kind, markdown) of a block element."""
    if n.tag == "table":
        rows = _table_rows(n)
        return ("table", pipe_table(rows)) if rows else None
    skip = frozenset({"dl", "ul", "ol"}) if n.tag == "li" else frozenset({"blockquote", "dl", "ol", "p", "pre", "table", "ul"}) if n.tag in ("dd", "dt") else frozenset()
    value = n.text(skip)
    if not value:
        return None
    if n.tag[0] == "h":
        return "heading", f"{'#' * int(n.tag[1])} {value}"
    depth = sum(a.tag == "li" for a in n.above())
    shapes = {"li": ("list_item", f"{'  ' * depth}- {value}"), "dt": ("definition_term", f"**{value}**"), "blockquote": ("paragraph", f"> {value}"), "figcaption": ("caption", f"Figure: {value}"), "pre": ("preformatted", f"```\n{value}\n```")}
    return shapes.get(n.tag, ("paragraph", value))


_SIMPLE = re.compile(r"""([.#])?([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*["']?([^"'\]]*)["']?\s*)?\]|(\*)""")


def selects(selector: str, n: Node) -> bool:
    """Whether a node fits one of the comma-separated selectors: tag, .class, #id and [attribute=value], also together and below others."""

    def simple(part: str, x: Node) -> bool:
        for mark, name, attribute, value, _ in _SIMPLE.findall(part):
            if attribute:
                ok = attribute in x.attrs and (not value or x.attrs[attribute] == value)
            elif mark == ".":
                ok = name in x.attrs.get("class", "").split()
            elif mark == "#":
                ok = x.attrs.get("id") == name
            else:
                ok = not name or x.tag == name.lower()
            if not ok:
                return False
        return True

    def chain(parts: list[str], x: Node) -> bool:
        if not simple(parts[-1], x):
            return False
        rest, up = parts[:-1], x.above()
        while rest:
            if not any(simple(rest[-1], a) for a in up):  # the ancestors go on where the last one was found
                return False
            rest = rest[:-1]
        return True

    return any(chain(one.split(), n) for one in selector.split(",") if one.strip())


def _spell_math(root: Node) -> None:
    """Formulas as $text$, those of a block of their own as $$text$$."""
    for n in list(root.walk()):
        if n.tag == "math":
            said = " ".join((n.attrs.get("alttext") or n.text()).split())
            said = re.sub(r"^\{\\(?:display|text)style\s*(.*)\}$", r"\1", said).strip()
            mark = "$$" if n.attrs.get("display") == "block" else "$"
            n.kids = [f" {mark}{said}{mark} "] if said else []
        elif n.tag == "img" and any(a.tag == "span" and "mwe-math-element" in a.attrs.get("class", "").split() for a in n.above()):
            n.kids = []


def html_blocks(html: str, article: bool = False, title: str | None = None, content: str | None = None, remove: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """(kind, markdown) of the blocks of a page's main part, in document order.

    content: a selector of the main part, an error if nothing fits; remove: selectors of what goes.
    """
    tree = _Tree()
    tree.feed(html)
    tree.close()
    every = list(tree.root.walk())
    if content:
        root = next((n for n in every if n is not tree.root and selects(content, n)), None)
        if root is None:
            raise ValueError(f"nothing fits the content selector {content}")
    else:
        root = next((n for tag in ("main", "article", "body") for n in every if n.tag == tag), tree.root)
    for n in list(root.walk()):
        if n is not root and n.parent is not None and any(selects(r, n) for r in remove):
            n.parent.kids.remove(n)
    _drop(root, article)
    _spell_math(root)
    out = [("title", f"# {' '.join(title.split())}")] if article and title and title.split() else []
    skipping = False
    for n in root.walk():
        if n.tag not in BLOCKS:
            continue
        if n.tag == "h2":
            skipping = article and n.text().rstrip(":").casefold() in ARTICLE_END
        above = {a.tag for a in n.above()}
        if skipping or "table" in above or (n.tag in ("p", "blockquote", "dd", "dt", "figcaption", "pre") and "li" in above):
            continue
        if block := _block(n, root):
            out.append(block)
    return out


def heading_run(kinds: list[str]) -> int:
    """Headings in front of the first block that is none."""
    body = next((i for i, k in enumerate(kinds) if k not in ("heading", "title")), len(kinds))
    return kinds[:body].count("heading")


def flatten(value, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, value) of the leaves of a JSON value: ``a.b[0]``; null is empty."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from flatten(v, f"{path}.{k}" if path else str(k))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from flatten(v, f"{path}[{i}]")
    else:
        yield path, "" if value is None else str(value)


def xml_leaves(text: str) -> list[tuple[str, str]]:
    """(path, text) of elements without children; namespaces are left out."""
    out = []

    def walk(e: ET.Element, path: str) -> None:
        here = f"{path}/{e.tag.rpartition('}')[2]}".lstrip("/")
        words = " ".join("".join(e.itertext()).split())
        if not len(e) and words:
            out.append((here, words))
        for kid in e:
            walk(kid, here)

    walk(ET.fromstring(text), "")
    return out


def csv_rows(text: str) -> list[list[str]]:
    """Rows under the dialect that the start of the text shows; where it shows none, the commonest separator of the first line."""
    lines = text.splitlines()
    if not lines:
        raise ValueError("empty CSV")
    try:
        return list(csv.reader(lines, csv.Sniffer().sniff(text[:4096])))
    except csv.Error:
        return list(csv.reader(lines, delimiter=max(",;\t|", key=lines[0].count)))


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def docx_markdown(content: bytes) -> str:
    """Paragraphs (headings by style), then tables."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    out, tables = [], []

    def words(e) -> str:
        return "".join(t.text or "" for t in e.iter(f"{_W}t")).strip()

    for e in body:
        if e.tag == f"{_W}p" and words(e):
            style = e.find(f"{_W}pPr/{_W}pStyle")
            level = re.search(r"heading\s*([1-6])", style.get(f"{_W}val", "") if style is not None else "", re.IGNORECASE)
            out.append(f"{'#' * int(level[1])} {words(e)}" if level else words(e))
        elif e.tag == f"{_W}tbl":
            tables.append([[words(c) for c in r.iter(f"{_W}tc")] for r in e.iter(f"{_W}tr")])
    for i, rows in enumerate(filter(None, tables), 1):
        out += [f"## Table {i}", pipe_table(rows)]
    return "\n\n".join(out)


def _cell(reference: str) -> tuple[int, int]:
    """(row, column) of a name such as AB12, from 1."""
    letters, digits = re.match(r"([A-Z]*)(\d*)", reference).groups()
    column = 0
    for x in letters:
        column = 26 * column + ord(x) - 64
    return int(digits or 0), column


def worksheets(content: bytes) -> list[tuple[str, dict[tuple[int, int], object], list[tuple[int, int, int, int]]]]:
    """(name, cells, merged ranges) of every sheet of a workbook: numbers as numbers, formulas as their cached values."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        out = []
        for i, sheet in enumerate(ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet"), 1):
            root = ET.fromstring(z.read(f"xl/worksheets/sheet{i}.xml"))
            cells: dict[tuple[int, int], object] = {}
            for n, r in enumerate(root.iter(f"{_S}row"), 1):
                row = int(r.get("r", n))
                for k, c in enumerate(r.iter(f"{_S}c"), 1):
                    v, kind = c.find(f"{_S}v"), c.get("t", "n")
                    raw = "".join(t.text or "" for t in c.iter(f"{_S}t")) if kind == "inlineStr" else (v.text or "" if v is not None else "")
                    number = kind == "n" and re.fullmatch(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?", raw)
                    value = shared[int(raw)] if kind == "s" and raw else float(raw) if number and not raw.lstrip("-").isdigit() else int(raw) if number else raw or None
                    cells[row, _cell(c.get("r", ""))[1] or k] = value
            merged = [(*_cell(a), *_cell(b)) for m in root.iter(f"{_S}mergeCell") for a, _, b in [m.get("ref", "").partition(":")] if b]
            out.append((sheet.get("name"), cells, merged))
    return out


def grid(cells: dict[tuple[int, int], object]) -> list[list]:
    """Cells as rows of equal length."""
    rows, columns = (max((k[i] for k in cells), default=0) for i in (0, 1))
    return [[cells.get((r, c)) for c in range(1, columns + 1)] for r in range(1, rows + 1)]


def xlsx_markdown(content: bytes) -> str:
    """Every sheet's rows that have a value."""
    out = []
    for name, cells, _ in worksheets(content):
        rows = [["" if v is None else str(v) for v in row] for row in grid(cells) if any(v is not None for v in row)]
        if rows:
            out += [f"# {name}", pipe_table(rows)]
    if not out:
        raise ValueError("no cell has a value")
    return "\n\n".join(out)


def to_markdown(content: bytes, mime: str, article: bool = False, title: str | None = None, main: str | None = None, remove: tuple[str, ...] = ()) -> tuple[str, list[str]]:
    """(markdown, block kinds) of one document."""
    if mime == "application/pdf":
        return pdf.markdown(content), []
    if "wordprocessingml" in mime:
        return docx_markdown(content), []
    if "spreadsheetml" in mime:
        return xlsx_markdown(content), []
    text = decode(content)
    if mime == "text/html":
        found = html_blocks(text, article, title, main, remove)
        return "\n\n".join(b for _, b in found), [k for k, _ in found]
    if mime == "application/json":
        rows = [[k.replace("|", "\\|"), v.replace("|", "\\|")] for k, v in flatten(json.loads(text))]
        return "# Structured record\n\n" + pipe_table([["Field", "Value"], *rows]), []
    if mime == "application/xml":
        return "# XML record\n\n" + pipe_table([["Element", "Value"], *map(list, xml_leaves(text))]), []
    if mime == "text/csv":
        return "# Table\n\n" + pipe_table(csv_rows(text)), []
    if mime.startswith("text/"):
        return text, []
    raise ValueError(f"no extractor for {mime}")


def decode(content: bytes) -> str:
    for encoding in ("utf-8-sig", "windows-1254", "latin-1"):
        try:
            return content.decode(encoding)
        except UnicodeDecodeError:
            continue
    return content.decode("latin-1")


#: Documents whose markdown a task holds.
PART = 128


def extract(files: DataFrame, article: bool = False) -> DataFrame:
    """path, markdown, kinds, headings_first, error of files (path, mime, content, and if there title, main and remove: a page's title and selectors)."""
    more = [c for c in ("title", "main", "remove") if c in files.columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), PART):
                rows = []
                for x in f.iloc[at : at + PART].itertuples(index=False):
                    try:
                        text, kinds = to_markdown(bytes(x.content), x.mime, article, **{c: tuple(v) if c == "remove" else v for c in more if (v := getattr(x, c)) is not None})
                        rows.append((x.path, text, kinds, heading_run(kinds), None))
                    except Exception as e:  # noqa: BLE001  one document's fault is its own row
                        rows.append((x.path, None, [], 0, f"{type(e).__name__}: {e}"[:500]))
                yield pd.DataFrame(rows, columns=["path", "markdown", "kinds", "headings_first", "error"])

    return files.select("path", "mime", "content", *more).mapInPandas(run, "path string, markdown string, kinds array<string>, headings_first int, error string")


def json_leaves(json_text: Column) -> Column:
    """One level of a JSON object as a map, null as empty."""
    return F.transform_values(F.from_json(json_text, "map<string,string>"), lambda k, v: F.coalesce(v, F.lit("")))


def table_records(rows: list[list[str]]) -> list[dict[str, str]]:
    """Rows of a table under its header: blank names are ``column_n``, repeated ones numbered from ``_2``."""
    if not rows:
        return []
    width, names, seen = max(map(len, rows)), [], {}
    for i, raw in enumerate([*rows[0], *[""] * (width - len(rows[0]))], 1):
        name = str(raw).strip() or f"column_{i}"
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return [dict(zip(names, [*map(str, r), *[""] * (width - len(r))], strict=True)) for r in rows[1:]]
