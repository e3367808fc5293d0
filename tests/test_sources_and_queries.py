import io
import zipfile
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lodestrand.functions.text import detect_mime
from lodestrand.operators import registry
from lodestrand.sources import extract, tables
from lodestrand.streaming import ingest

PAGE = """<html><body><nav><p>menu</p></nav><main><h1>Title</h1><p>One <b>two</b></p><ul><li>a<ul><li>b</li></ul></li></ul>
<table><tr><th>k</th><th>v|w</th></tr><tr><td>1</td></tr></table><dl><dt>t</dt><dd>d</dd></dl><pre>x  y</pre><h2>References</h2><p>gone</p></main><footer>f</footer></body></html>"""


def test_html():
    blocks = extract.html_blocks(PAGE, article=True, title=" T  t ")
    assert [b for _, b in blocks] == ["# T t", "# Title", "One two", "- a", "  - b", "| k | v\\|w |\n| --- | --- |\n| 1 |  |", "**t**", "d", "```\nx y\n```"]
    assert ("heading", "## References") in extract.html_blocks(PAGE) and extract.heading_run([k for k, _ in blocks]) == 1
    assert extract.html_blocks("") == [] and extract.html_blocks("<p>a<p>b") == [("paragraph", "a"), ("paragraph", "b")]


def _zip(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k, v in files.items():
            z.writestr(k, v)
    return out.getvalue()


def test_formats(spark, tmp_path):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    s = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    docx = _zip({"word/document.xml": f'<w:document xmlns:w="{w}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>H</w:t></w:r></w:p><w:p><w:r><w:t>text</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'})
    xlsx = _zip({"xl/workbook.xml": f'<workbook xmlns="{s}"><sheets><sheet name="Traffic"/></sheets></workbook>', "xl/sharedStrings.xml": f'<sst xmlns="{s}"><si><t>k</t></si></sst>', "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{s}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>7</v></c></row><row><c r="A2"/></row></sheetData></worksheet>'})
    files = {"a.json": b'{"aircraft": {"n": null, "l": [1, "x|y"]}}', "b.csv": b"code;name\nA;1\nB", "c.xml": b'<?xml version="1.0"?><r xmlns="u"><c> x </c><d><e>1</e></d></r>', "d.docx": docx, "e.xlsx": xlsx, "f.html": PAGE.encode(), "g.bin": b"\x00\x01", "h.txt": "caf\xe9".encode("latin-1"), "i.txt": "caf\xe9".encode("latin-1")}
    for k, v in files.items():
        (tmp_path / k).write_bytes(v)
    read = tables.read_files(spark, f"file://{tmp_path}/*")
    assert read.count() == 8 and tables.read_files(spark, f"file://{tmp_path}/*", limit=10).count() == 2
    with pytest.raises(ValueError, match="leave"):
        tables.read_files(spark, "../x")
    got = {r.path.rsplit("/", 1)[1]: r for r in extract.extract(read).collect()}
    assert got["a.json"].markdown.endswith("| aircraft.n |  |\n| aircraft.l[0] | 1 |\n| aircraft.l[1] | x\\|y |")
    assert got["b.csv"].markdown == "# Table\n\n| code | name |\n| --- | --- |\n| A | 1 |\n| B |  |"
    assert got["c.xml"].markdown.endswith("| r/c | x |\n| r/d/e | 1 |")
    assert got["d.docx"].markdown == "# H\n\ntext\n\n## Table 1\n\n| a |\n| --- |"
    assert got["e.xlsx"].markdown == "# Traffic\n\n| k |  | 7 |\n| --- | --- | --- |"
    assert got["f.html"].headings_first == 1 and got["h.txt"].markdown == "café" and "no extractor" in got["g.bin"].error


def test_mime(spark):
    rows = [(b"PK..", "x.xlsx", None), (b"%PDF-1", "x", None), (b" <HTML>", "x", None), (b"[1]", "x", "application/octet-stream"), (b"x", "x", "Text/Plain; charset=utf-8"), (b"x", "x.csv", None), (b"", "x", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "c binary, p string, d string").select(detect_mime(F.col("c"), F.col("p"), F.col("d"))).collect()]
    assert [g.rsplit(".", 1)[-1] for g in got] == ["sheet", "application/pdf", "text/html", "application/json", "text/plain", "text/csv", "application/octet-stream"]


def test_record_files(spark, tmp_path):
    schema = "id int, tags array<string>"
    assert tables.read_records(spark, f"{tmp_path}/none", schema).count() == 0
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], schema)
    for kind in ("json", "parquet"):
        tables.write_records(df, f"{tmp_path}/{kind}", kind)
        assert sorted(map(tuple, tables.read_records(spark, f"{tmp_path}/{kind}", schema, kind).collect())) == [(1, ["a", "b"]), (2, [])]
    tables.write_records(df, f"{tmp_path}/csv", "csv")
    assert {r.tags for r in spark.read.option("header", True).csv(f"{tmp_path}/csv").collect()} == {"a|b", None}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/x.json").write_text('{"id": "no"}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_records(spark, f"{tmp_path}/bad", schema).collect()
    tables.promote(df, f"{tmp_path}/base", "v1", f"{tmp_path}/pointers")
    tables.promote(df.limit(1), f"{tmp_path}/base", "v2", f"{tmp_path}/pointers")
    assert tables.current(spark, f"{tmp_path}/pointers", f"{tmp_path}/base").count() == 1
    merged = tables.merge_manifest(spark.createDataFrame([(1, "a", 1), (2, "a", 5)], "k int, v string, t int"), spark.createDataFrame([(1, "b", 1), (2, "b", 4)], "k int, v string, t int"), "k", "t")
    assert sorted((r.k, r.v) for r in merged.collect()) == [(1, "b"), (2, "a")]


def test_registry_and_release(spark):
    open_ = ("open", "CC", "l", "t", "a", True, True, True)
    rows = [("good", "file", True, ["x"], False, None, open_), ("none", "ftp", True, [], False, None, ("blocked", "", "", "t", "a", False, False, True)), ("wiki", "mediawiki_api", True, ["a", "b"], False, None, open_), ("glob", "local_glob", True, ["../x", "/y"], True, None, open_)]
    found = {(r.source_id, r.code) for r in registry.audit(spark.createDataFrame(rows, registry.SOURCE), "replace-with@me").collect()}
    assert found == {("none", "adapter_not_implemented"), ("none", "blocked_enabled"), ("none", "restricted_release_flag"), ("none", "missing_seed"), ("none", "incomplete_rights_evidence"), ("wiki", "missing_mediawiki_config"), ("wiki", "invalid_mediawiki_endpoint_count"), ("wiki", "missing_mediawiki_extraction_profile"), ("glob", "unsafe_local_glob"), ("glob", "unexpected_mediawiki_config"), ("_project", "placeholder_contact")}
    rights = "struct<state:string,release_source:boolean,release_derived_text:boolean>"
    sources = spark.createDataFrame([("s", ("open", True, True)), ("t", ("blocked", False, False))], f"source_record_id string, rights {rights}")
    docs = spark.createDataFrame([("d1", "s", "open", True, True), ("d2", "t", "open", True, True), ("d3", "s", "manifest_only", True, True), ("d4", "x", "open", True, True)], "document_id string, source_record_id string, rights_state string, release_derived_text boolean, release_qa boolean")
    passages = spark.createDataFrame([("p1", "d1"), ("p3", "d3")], "passage_id string, document_id string")
    qa = spark.createDataFrame([("q1", ["d1"], [("p1",)]), ("q2", ["d1", "d3"], [("p1",)]), ("q3", ["d1"], [("p3",)]), ("q4", [], [])], "qa_id string, source_document_ids array<string>, evidence array<struct<passage_id:string>>")
    out = registry.release(docs, sources, passages, qa)
    assert {r.qa_id for r in out["questions"].collect()} == {"q1", "q3", "q4"} and out["passages"].count() == 1
    assert {tuple(r) for r in out["violations"].collect()} == {("inconsistent_open_rights", "d2"), ("source_missing", "d4"), ("evidence_not_public", "q3")}
    cats = spark.createDataFrame([(["Category:Air_lines", "x"],), (["years 1999"],), ([],)], "c array<string>")
    assert [r[0] for r in cats.select(registry.category_matches(F.col("c"), ["air lines"], [r"\d{4}"])).collect()] == [True, True, False]


def test_stream(spark, tmp_path):
    schema = "source_id string, sha256 string, byte_size long, retrieved_at timestamp"
    (tmp_path / "in").mkdir()

    def arrive(name, rows):
        (tmp_path / "in" / name).write_text("".join('{"source_id":"%s","sha256":"%s","byte_size":%d,"retrieved_at":"2024-01-01T00:00:00"}\n' % r for r in rows))
        ingest.append(ingest.new_records(spark, f"{tmp_path}/in", schema), f"{tmp_path}/table", f"{tmp_path}/check").awaitTermination()

    arrive("a.json", [("s", "1", 5), ("s", "1", 5), ("s", "2", 7)])
    arrive("b.json", [("s", "2", 7), ("t", "2", 9)])
    assert sorted((r.source_id, r.sha256) for r in spark.read.parquet(f"{tmp_path}/table").collect()) == [("s", "1"), ("s", "2"), ("t", "2")]


def test_entry_points(spark, sf_dir):
    assert entry.entry(spark).count() == 4
    assert set(entry.oracle_sql()) <= set(entry.queries())


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries whose results no SQL gives: their columns, and what every row of them must hold.
PLAIN = {
    "evidence_candidates": "token_count >= 8 and passage_char_end > passage_char_start and types <> ''",
    "candidate_capacity": "candidates >= passages and passages > 0",
    "planned_tasks": "kind in ('model', 'mutation') and task_id like 'task_%'",
    "validated_questions": "question is not null and qa_id like 'qa_%'",
    "unanswerable_questions": "error is not null or question <> source_value",
    "rejections": "n > 0 and dimension in ('reason', 'language', 'type', 'passage', 'document', 'construction_stage')",
    "page_markdown": "error is null and length(markdown) > 0",
    "quota_plan": "count > 0",
    "built_questions": "question is not null and qa_id like 'qa_%' and stratum like '%:%'",
}


@pytest.mark.parametrize("name", PLAIN)
def test_queries_without_sql(spark, sf_dir, name):
    rows = entry.queries()[name](spark, sf_dir).cache()
    assert rows.count() > 0 and rows.filter(f"not coalesce({PLAIN[name]}, false)").count() == 0


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def in_order(columns, rows):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(f"{float(v):.6g}" if isinstance(v, (float, Decimal)) else str(v) for v in (r[i] for i in at)) for r in rows)


@pytest.mark.parametrize("name", sorted(k for k, f in entry.queries().items() if f.__module__.startswith("lodestrand.plans") and k in entry.oracle_sql()))
def test_queries_equal_their_sql(spark, sf_dir, duck, name):
    mine = entry.queries()[name](spark, sf_dir)
    theirs = duck.execute(entry.oracle_sql()[name])
    assert in_order(mine.columns, mine.collect()) == in_order([c[0] for c in theirs.description], theirs.fetchall())
