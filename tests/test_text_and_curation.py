import json
import re
import unicodedata
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lodestrand.functions import answers as A
from lodestrand.functions import text as T
from lodestrand.operators import curate, dedup, sampling

TEXTS = ["", " ", "It's the co-pilot's A321.neo, isn't it? x_1", "İSTANBUL'a ﬁnal ½ — straße", "a\r\nb \t\n\n c\x0b", "Ölçüm: 3,5 km… 日本語テスト", "The and with\nhava için bir", "|a|b|\n" * 3]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")


def by_i(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_tokens(texts):
    word = re.compile(r"\w+(?:['’.-]\w+)*")
    assert by_i(texts, T.tokens(F.col("t"))) == [word.findall(t) for t in TEXTS]
    assert by_i(texts, T.normalized_tokens(F.col("t"), exact=True)) == [[w.casefold() for w in word.findall(unicodedata.normalize("NFKC", t).casefold())] for t in TEXTS]


def test_normal_forms(texts):
    def plain(t):
        t = unicodedata.normalize("NFKC", t).replace("\r\n", "\n").replace("\r", "\n")
        return "\n".join(x.rstrip() for x in t.split("\n")).strip() + "\n"

    assert by_i(texts, T.normalize_text(F.col("t"))) == [plain(t) for t in TEXTS]
    assert by_i(texts, T.normalized_for_hash(F.col("t"), exact=True)) == [" ".join(plain(t).casefold().split()) for t in TEXTS]


def test_stable_id(texts):
    got = by_i(texts, T.stable_id("p", F.col("t"), F.col("i"), F.lit(True), length=32))
    want = ["p_" + sha256(json.dumps([t, i, True], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:32] for i, t in enumerate(TEXTS)]
    assert [g for g, t in zip(got, TEXTS, strict=True) if "\x0b" not in t] == [w for w, t in zip(want, TEXTS, strict=True) if "\x0b" not in t]


def test_language_and_flags(spark, texts):
    assert by_i(texts, T.detect_language(F.col("t")))[6] == "tr" and by_i(texts, T.detect_language(F.col("t")))[0] == "und"
    long = "- " + "word " * 30
    rows = [(0, "\n".join([long] * 40)), (1, "short"), (2, "\n".join(f"{i} {long[2:]}" for i in range(30))), (3, "x " * 12 + "�")]
    flags = by_i(spark.createDataFrame(rows, "i int, t string"), T.quality_flags(F.col("t")))
    assert flags == [["list_heavy_document", "excessive_duplicate_lines"], ["very_short"], [], ["encoding_replacement_noise"]]


def test_curate(spark):
    body = "these are ten or more plain words in one accepted document "
    rows = [(3, body * 2, ["airlines"], None), (1, (body * 2).upper(), [], None), (2, body + "mail me@example.org", [], None), (4, body + "the current fleet", ["airlines"], None), (5, body + "the current fleet", ["airlines"], "2020")]
    got = {r.doc_id: r for r in curate.curate(spark.createDataFrame(rows, "doc_id int, text string, topics array<string>, as_of string")).collect()}
    assert got[3].duplicate_of == 1 and got[1].duplicate_of is None and not got[3].accepted and got[1].accepted
    assert got[2].flags == ["possible_personal_data"] and got[4].flags == ["current_airline_claim_missing_as_of"]
    assert got[5].flags == ["exact_duplicate"] and got[5].duplicate_of == 4  # its owner counts even when rejected


def test_shares_and_quotas(spark):
    docs = spark.createDataFrame([(1, ["a", "b"], "f", 60), (2, ["a"], "g", 40)], "i int, topics array<string>, family string, n int")
    topics, families = curate.topic_shares(docs, "topics", "n"), curate.shares(docs, "family", "n")
    assert {r.key: r.share for r in topics.collect()} == {"a": 0.7, "b": 0.3}
    issues = {(r.code, r.key) for r in curate.quota_issues(topics, families, ["a", "b", "c"]).collect()}
    assert issues == {("topic_minimum", "c"), ("source_family_cap", "f")}
    assert curate.shares(docs.limit(0), "family", "n").count() == 0


def test_answers(spark):
    rows = [("The cat, 3.5 km!", ["cat 3,5 km"], True), ("", [""], True), ("on 01/02/2020", ["2020-02-01 on"], False), ("b; a", ["a and b", "c"], True), ("x y", ["y z", "x"], False)]
    got = spark.createDataFrame(rows, "p string, r array<string>, l boolean").select(*(c.alias(n) for n, c in A.answer_scores(F.col("p"), F.col("r"), F.col("l")).items())).collect()
    assert [r.exact_match for r in got] == [0.0, 1.0, 0.0, 0.0, 0.0]
    assert got[1].token_f1 == 1.0 and got[1].list_set_f1 == 0.0 and got[1].numeric_date_equivalence is None
    assert got[2].numeric_date_equivalence == 0.0 and got[3].list_set_f1 == 1.0 and got[4].token_f1 == pytest.approx(2 / 3)
    assert got[4].list_set_f1 is None


def test_components_and_filter(spark):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "node int")
    edges = spark.createDataFrame([(i, i + 1) for i in range(7)] + [(9, 8)], "a int, b int")
    got = {r.node: r.component for r in dedup.components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(8)}, 8: 8, 9: 8, 10: 10, 11: 11}
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 5)], "a int, b int")
    kept = {r.key: r.kept for r in dedup.ordered_filter(spark.createDataFrame([(i,) for i in range(1, 7)], "key int"), chain).collect()}
    assert kept == {1: True, 2: False, 3: True, 4: False, 5: False, 6: True}


def test_question_filter(spark):
    base = "what is the exact maximum takeoff mass of the aircraft that the passage names in its first table of limits"
    rows = [(1, base), (2, base.upper() + "  "), (3, base + " x"), (4, "another question"), (5, "another  question")]
    got = {r.key: r.reason for r in dedup.question_filter(spark.createDataFrame(rows, "key int, text string")).collect()}
    assert got == {1: None, 2: "duplicate_question", 3: "near_duplicate_question", 4: None, 5: "duplicate_question"}


def test_split_groups(spark):
    docs = spark.createDataFrame([("a", "v1", "e"), ("b", "v2", "e"), ("c", "v3", None), ("d", "v4", None)], "document_id string, variant_group_id string, entity_group_id string")
    cited = spark.createDataFrame([("q1", "a", 0), ("q2", "b", 0), ("q3", "c", 0), ("q3", "d", 1), ("q4", "d", 0)], "qa_id string, document_id string, position int")
    got = {r.qa_id: r for r in dedup.split_components(docs, cited).collect()}
    assert got["q1"].split_group_id == got["q2"].split_group_id != got["q3"].split_group_id == got["q4"].split_group_id
    value = int(sha256(got["q1"].split_group_id.encode()).hexdigest()[:8], 16) % 100
    assert got["q1"].split == ("train" if value < 70 else "validation" if value < 85 else "test")


def test_quota_plan():
    p = sampling.quota_plan(1500)
    assert p["question_language"] == {"en": 750, "tr": 750} and p["answerability"] == {"answerable": 1350, "corpus_unanswerable": 150}
    assert p["answerable_cross_lingual"] == 135 and sum(s["count"] for s in p["answerable_strata"]) == 1350
    assert sum(s["count"] for s in p["answerable_strata"] if s["cross_lingual"]) == 135
    for n in (1, 7, 33, 999):
        assert sum(s["count"] for s in sampling.quota_plan(n)["answerable_strata"]) == sampling.quota_plan(n)["answerability"]["answerable"]


def test_review_sample(spark):
    rows = spark.range(1500).select(F.concat(F.lit("q"), "id").alias("qa_id"), (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("b"))
    got = sampling.review_sample(rows, ["a", "b"], "qa_id", 0.15)
    assert got.count() == 450 and got.select("qa_id").distinct().count() == 225
    per = sampling.sample_per_stratum(rows, ["a"], "qa_id", 0.001)
    assert per.count() == 7
    with pytest.raises(ValueError, match="rate"):
        sampling.sample_per_stratum(rows, ["a"], "qa_id", 0)


def test_agreement_and_gates(spark):
    votes = [("a", 1, True), ("a", 2, True), ("b", 1, False), ("b", 2, True), ("c", 1, True)]
    r = sampling.agreement(spark.createDataFrame(votes, "q string, o int, v boolean"), "q", "o", "v").first()
    assert (r.review_rows, r.reviewed_items, r.double_reviewed_items, r.rate) == (5, 3, 2, 0.8) and r.kappa == 0.0
    assert sampling.agreement(spark.createDataFrame([("a", 1, True), ("a", 2, True)], "q string, o int, v boolean"), "q", "o", "v").first().kappa == 1.0
    rows = spark.createDataFrame([("x", 1.0, ">=", 1.0, False), ("y", None, ">=", 1.0, True), ("z", None, ">=", 1.0, False)], "gate string, actual double, op string, threshold double, nullable boolean")
    held = sampling.gates(rows)
    assert {r.gate: r.status for r in held.collect()} == {"x": "pass", "y": "not_evaluated", "z": "fail"}
    assert sampling.verdict(held).first()[0] == "fail" and sampling.verdict(held.filter("gate <> 'z'")).first()[0] == "not_evaluated"


def test_quota_select(spark):
    rows = spark.createDataFrame([("en", None, i) for i in range(5)] + [("tr", "x", 1)], "l string, t string, o int")
    quotas = spark.createDataFrame([("en", None, 3), ("tr", "x", 2)], "l string, t string, count long")
    kept, over, short = sampling.quota_select(rows, quotas, ["l", "t"], ["o"])
    assert sorted(r.o for r in kept.filter("l = 'en'").collect()) == [0, 1, 2] and over.count() == 2
    assert [tuple(r) for r in short.collect()] == [("tr", "x", 2, 1, 1)]


def test_sets_are_hashed_as_they_are_made_and_bands_are_made_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f g a b c d e"), (2, "a b c d e f g a b c d e"), (3, "one"), (4, ""), (5, None), (6, "")], "doc_id int, text string")
    words = T.normalized_tokens(F.col("text"))
    plain, hashed = F.transform(T.shingles(words, 5), lambda x: F.xxhash64(x)), F.array_distinct(T.shingles(words, 5, hashed=True))
    assert docs.filter(~plain.eqNullSafe(hashed)).count() == 0
    seen = []
    whole = dedup.cut
    monkeypatch.setattr(dedup, "cut", lambda df: seen.append(df.columns) or whole(df))
    got = {r.doc_id: (r.component, r.group_size) for r in dedup.near_duplicate_groups(docs).collect()}
    assert {k: got[k] for k in (1, 2, 3)} == {1: (1, 2), 2: (1, 2), 3: (3, 1)} and got[4] == got[6] and len(got) == 6
    assert ["rep", "bucket"] in seen
