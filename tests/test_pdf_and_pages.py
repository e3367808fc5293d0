import io
import json
import zipfile
import zlib

import pytest

from lodestrand.sources import extract, pdf, profiles


def made_pdf(pages, bookmarks=(), flate=True):
    """A PDF of pages of (x, y from the bottom, text) lines; bookmarks: (level, title, page, y from the bottom)."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R" + (b" /Outlines 3 0 R" if bookmarks else b"") + b" >>"}
    kids = " ".join(f"{10 + 2 * i} 0 R" for i in range(len(pages)))
    objects[2] = f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} /MediaBox [0 0 612 792] >>".encode()
    for i, lines in enumerate(pages):
        body = "\n".join(f"BT /F1 11 Tf 1 0 0 1 {x} {y} Tm ({t}) Tj ET" for x, y, t in lines).encode("cp1252")
        body = zlib.compress(body) if flate else body
        objects[10 + 2 * i] = f"<< /Type /Page /Parent 2 0 R /Contents {11 + 2 * i} 0 R >>".encode()
        objects[11 + 2 * i] = f"<< /Length {len(body)}{' /Filter /FlateDecode' if flate else ''} >>\nstream\n".encode() + body + b"\nendstream"
    if bookmarks:
        base = 100
        objects[3] = f"<< /First {base} 0 R >>".encode()
        for i, (level, title, page, y) in enumerate(bookmarks):
            later = bookmarks[i + 1 :]
            first = i + 1 if later and later[0][0] > level else None
            after = next((j for j, b in enumerate(later, i + 1) if b[0] <= level), None)
            after = after if after is not None and bookmarks[after][0] == level else None
            links = (f" /First {base + first} 0 R" if first else "") + (f" /Next {base + after} 0 R" if after else "")
            objects[base + i] = f"<< /Title ({title}) /Dest [{10 + 2 * (page - 1)} 0 R /XYZ 0 {y} 0]{links} >>".encode()
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % (n, o) for n, o in objects.items()) + b"\ntrailer << /Root 1 0 R >>\nstartxref\n0\n%%EOF"


@pytest.mark.parametrize("flate", [True, False])
def test_pdf_text(flate):
    data = made_pdf([[(72, 700, "First \\(page\\)"), (72, 680, "caf\xe9 two"), (200, 680, "same line")], [(72, 700, "Last")]], flate=flate)
    assert pdf.markdown(data) == "<!-- page:1 -->\n\nFirst (page)\ncafé two same line\n\n<!-- page:2 -->\n\nLast"
    assert extract.to_markdown(data, "application/pdf")[0] == pdf.markdown(data)
    with pytest.raises(ValueError):
        pdf.markdown(b"%PDF-1.4 nothing")


def test_profiles_read_files(spark):
    words = "some words that make a section long enough"
    section = made_pdf([[(72, 700, "CS-E 10 Scope"), (72, 650, words)], [(72, 700, "CS-E 20 More"), (72, 650, words + " again")]], [(1, "Book", 1, 760), (2, "CS-E 10 Scope", 1, 720), (2, "CS-E 20 More", 2, 720)])
    purpose = made_pdf([[(72, 700, "Contents")], [(72, 700, "1 PURPOSE"), (72, 650, words), (72, 600, "2 APPLICABILITY"), (72, 550, words), (72, 500, "3 DEFINITIONS."), (72, 450, words)]])
    entries = made_pdf([[(72, 700, "Tan\u0131mlar ve k\u0131saltmalar".encode("cp1254").decode("cp1252"))]])
    s = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData><mergeCells><mergeCell ref="B2:C2"/></mergeCells></worksheet>'
    cell = lambda ref, v: f'<c r="{ref}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    rows = [{"A1": "Traffic"}, {"A2": "Airport", "B2": "Flights"}, {"B3": "in", "C3": "out"}, {"A4": "X", "B4": 5, "C4": 6.5}, {"A5": "Total", "B5": 5, "C5": 6.5}]
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheets><sheet name="S"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", s.format("".join(f'<row r="{i}">{"".join(cell(k, v) for k, v in r.items())}</row>' for i, r in enumerate(rows, 1))))
    files = [("s", "section", section), ("p", "purpose", purpose), ("a", "abbreviations", entries), ("w", "sheet", box.getvalue())]
    got = {r.path: r for r in profiles.extract_profiles(spark.createDataFrame(files, "path string, profile string, content binary"), 3).collect()}
    assert json.loads(got["s"].result)["eligible"] == 2 and words in json.loads(got["s"].result)["text"]
    assert json.loads(got["p"].result)["method"] == "headings" and words in json.loads(got["p"].result)["applicability"]
    assert got["a"].result is None and "ValueError" in got["a"].error
    assert json.loads(got["w"].result).splitlines()[2:] == ["| Airport | Flights / in | Flights / out |", "| --- | --- | --- |", "| X | 5 | 6.5 |", "| Total | 5 | 6.5 |"]


def test_selectors_removals_and_math(spark):
    html = """<body><div id="c" class="x main"><p>keep <math alttext="{\\displaystyle a^2}"><mi>a</mi></math></p><p class="ad big">gone</p>
    <section data-k="v"><p>in section</p></section><math display="block" alttext="b"></math></div><div><p>outside</p></div></body>"""
    blocks = [t for _, t in extract.html_blocks(html, content="div.main", remove=(".ad", "[data-k=v] p"))]
    assert blocks == ["keep $a^2$"]
    assert [t for _, t in extract.html_blocks(html, content="#c section")] == ["in section"]
    with pytest.raises(ValueError):
        extract.html_blocks(html, content=".none")
    rows = [("a", "text/html", html.encode(), "div.main", [".ad"]), ("b", "text/html", html.encode(), ".none", None), ("c", "text/html", html.encode(), None, None)]
    got = {r.path: r for r in extract.extract(spark.createDataFrame(rows, "path string, mime string, content binary, main string, remove array<string>")).collect()}
    assert "gone" not in got["a"].markdown and "outside" not in got["a"].markdown and got["b"].error and "outside" in got["c"].markdown
