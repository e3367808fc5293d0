from hashlib import sha256

from lodestrand.operators import passages, records
from lodestrand.plans import catalog
from lodestrand.sources import extract, tables


def test_schemas(spark):
    for name in records.SCHEMAS:
        assert records.export(name)["type"] == "struct" and len(records.schema(name)) > 5


def test_passages_and_questions(spark):
    digest = sha256(b"abc").hexdigest()
    rows = [("p", "d", "1", "v", "en", [], None, None, 0, 3, "abc", 1, digest), ("q", "d", "1", "v", "en", [], None, None, 3, 3, "abc", 1, "x"), ("p", "d", "1", "v", "en", [], None, None, 0, 3, "abc", 1, digest)]
    got = [sorted(r.violations) for r in records.check(spark.createDataFrame(rows, records.SCHEMAS["passage"]), "passage", "passage_id").orderBy("passage_id").collect()]
    assert got == [["duplicate_key"], ["duplicate_key"], ["bad_offsets", "checksum_mismatch", "length_mismatch"]]
    span = ("p", "d", 0, 3, 0, 3, "abc", digest)
    good = ("a", "q?", "abc", ["abc"], None, [], "en", ["en"], False, "factual", "answerable", [span], ["abc"], ["p"], ["d"], "g")
    bad = ("b", "q?", "abc", [], None, [], "en", ["tr"], False, "definition", "answerable", [(*span[:6], "abcd", digest)], [], ["p"], ["d"], "g")
    none = ("c", "q?", "x", [], None, [], "en", [], False, "factual", "corpus_unanswerable", [], [], [], [], "g")
    got = {r.qa_id: set(r.violations) for r in records.check(spark.createDataFrame([good, bad, none], records.SCHEMAS["question"]), "question").collect()}
    assert got == {"a": set(), "b": {"span_length_mismatch", "reference_expected", "cross_lingual_mismatch"}, "c": {"unanswerable_holds_answer"}}


def test_small_helpers(spark, sf_dir):
    assert extract.table_records([["a", "", "a"], ["1"], ["2", "3", "4", "5"]]) == [{"a": "1", "column_2": "", "a_2": "", "column_4": ""}, {"a": "2", "column_2": "3", "a_2": "4", "column_4": "5"}]
    df = spark.createDataFrame([(None, "", "e", None, "f" * 64), (None, None, None, "", "f" * 64)], "x string, h string, e string, m string, s string")
    assert [r[0] for r in df.select(tables.record_version("x", "h", "e", "m", "s")).collect()] == ["e", "f" * 16]
    made = passages.passages(catalog._documents(spark, sf_dir))
    assert made.count() > 0 and records.check(made, "passage", "passage_id").filter("size(violations) > 0").count() == 0
