"""Acquisition, reports, plan extension, settled questions and the command line."""

import json
import random
from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from lodestrand.__main__ import main
from lodestrand.operators import acquire, passages, planner, questions, report, retrieval
from lodestrand.sources import registry_file


def test_running_sums_equal_plain_ones(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aaab"), i, rng.randint(0, 9)) for i in range(3000)] + [(None, 1, 5), (None, 2, 6)]
    frame = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
    got = {(r.g, r.i): r.total for r in acquire.running_sum(frame, "g", ["i"], "v").collect()}
    for g in ("a", "b", None):
        own = sorted((i, v) for x, i, v in rows if x == g)
        assert [got[g, i] for i, _ in own] == list(accumulate(v for _, v in own))
    batches = acquire.batched(frame.filter("g = 'a'").select("i"), ["i"], 64).collect()
    assert max(Counter(r.batch for r in batches).values()) == 64 and {r.batch for r in batches} == set(range(-(-len(batches) // 64)))


def test_short_items_are_searched_for_together(spark):
    docs = spark.createDataFrame([(1, "a cat sat on the mat"), (2, "concatenate"), (3, None), (4, "nothing")], "d long, text string")
    items = spark.createDataFrame([(7, "cat"), (8, "on the"), (9, ""), (10, "cat"), (11, "a cat sat on the mat")], "i long, text string")
    assert sorted(map(tuple, retrieval.contains(docs, items, "d", "i").collect())) == [(1, 7), (1, 8), (1, 10), (1, 11), (2, 7), (2, 10)]


def test_bm25_in_turns(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choice(["ant", "bee", "cow", "dog", "eel"]) for _ in range(12))) for i in range(50)], "p long, text string")
    asked = spark.createDataFrame([(1, "ant bee"), (2, "cow cow"), (3, "none"), (4, "dog eel ant")], "q long, text string")
    whole = sorted(map(tuple, retrieval.bm25(docs, asked, "p", "q", top=5).collect()))
    monkeypatch.setattr(retrieval, "SHIPPED", 2)
    assert sorted(map(tuple, retrieval.bm25(docs, asked, "p", "q", top=5).collect())) == whole and len(whole) == 20


def test_registry_file(spark, tmp_path):
    rights = {"state": "open", "license_id": "CC", "license_url": "l", "terms_url": "t", "attribution": "a", "release_source": True, "release_derived_text": True, "release_qa": True}
    entries = [{"source_id": "a", "adapter": "file", "seed_urls": ["x"], "rights": rights}, {"source_id": "b", "adapter": "ftp", "enabled": True, "seed_urls": [], "rights": {**rights, "state": "blocked"}}]
    (tmp_path / "r.json").write_text(json.dumps({"sources": entries}))
    rows = registry_file.load_registry(spark, f"{tmp_path}/r.json")
    assert [r.source_id for r in rows.orderBy("source_id").collect()] == ["a", "b"]
    yaml = pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text(yaml.safe_dump({"sources": entries}))
    assert registry_file.load_registry(spark, f"{tmp_path}/r.yaml").collect() == rows.collect()
    known, errors = registry_file.with_sources(spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "source_id string, n int"), rows)
    assert [(r.n, r.adapter) for r in known.collect()] == [(1, "file")] and sorted(r.n for r in errors.collect()) == [2, 3]
    (tmp_path / "twice.json").write_text(json.dumps([entries[0], entries[0]]))
    with pytest.raises(ValueError):
        registry_file.load_registry(spark, f"{tmp_path}/twice.json")
    assert main(["audit", f"{tmp_path}/r.json"], spark) == 1
    (tmp_path / "good.json").write_text(json.dumps(entries[:1]))
    assert main(["audit", f"{tmp_path}/good.json"], spark) == 0
    assert main(["schemas"], spark) == 0 and main(["query", "segment_quotas", "/root/testdata/sf0.001"], spark) == 0


def test_gates(spark, tmp_path):
    good = {"schema_and_checksum_coverage": 1.0, "accepted_document_count": 500, "usable_extraction_manual_sample": 0.95, "structured_generation_success": 0.99, "accepted_qa_count": 1500, "exact_evidence_offset_validity": 1.0, "production_tokenizer_pinned": True, "topic_and_releasable_source_family_gates": 0, "qa_balance_quotas": 0, "double_review_complete": True, "airline_cohort_frozen": True, "human_correctness_and_grounding": 0.95, "reviewer_agreement_kappa": 0.7}
    assert len(good) == len(report.GATES) == 13
    for change, status in ((None, 0), ({"accepted_qa_count": 1499}, 1), ({"reviewer_agreement_kappa": None}, 0), ({"airline_cohort_frozen": False}, 1)):
        (tmp_path / "facts.json").write_text(json.dumps({**good, **(change or {})}))
        assert main(["report", f"{tmp_path}/facts.json"], spark) == status
    rows = {r.gate: r.status for r in report.gate_rows(spark.range(1).select(F.lit(1.0).alias("schema_and_checksum_coverage"))).collect()}
    assert rows["schema_and_checksum_coverage"] == "pass" and rows["reviewer_agreement_kappa"] == "not_evaluated" and rows["accepted_qa_count"] == "fail"
    assert report.pinned("a" * 40) and not report.pinned("main")


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    text = lambda i: "\n\n".join(f"The {rng.choice(['North', 'South'])} Tower {i} {k} was opened in {1900 + (i * 7 + k) % 120} and is larger than the others of its kind by {k + 3} metres in all." for k in range(6))
    docs = [(f"d{i}", "1", f"v{i}", ["en", "tr"][i % 2], text(i), "open", True, True, True) for i in range(40)]
    frame = spark.createDataFrame(docs, "document_id string, document_version string, variant_group_id string, language string, text string, rights_state string, release_qa boolean, release_derived_text boolean, accepted boolean").cache()
    rows = passages.passages(frame).cache()
    return frame, rows, passages.evidence_candidates(rows).cache()


def test_eligible_passages(spark, corpus):
    docs, rows, _ = corpus
    assert passages.eligible(rows, docs).count() == rows.count()
    with pytest.raises(ValueError):
        passages.eligible(rows, docs.withColumn("accepted", F.lit(False)))


def test_extended_plan_respects_what_is_there(spark, corpus, tmp_path):
    _, _, found = corpus
    tasks, _ = planner.plan_tasks(found, 30, 5, strict=False)
    short = spark.createDataFrame([("en", "factual", False, 6), ("tr", "temporal", False, 4), ("en", "comparison", True, 1)], "question_language string, primary_type string, cross_lingual boolean, deficit int")
    more, issues = planner.extend_tasks(tasks, found, short, 5)
    made, own = more.collect(), {r.anchor_id: r for r in found.collect()}
    assert len(made) + sum(i["requested"] - i["scheduled"] for i in issues) == 11
    old = tasks.filter("kind = 'model'").collect()
    assert not {r.anchor_id for r in made} & {r.anchor_id for r in old}
    pairs = Counter((own[r.anchor_id].passage_id, r.qa_type) for r in [*old, *made])
    uses = Counter(own[r.anchor_id].passage_id for r in [*old, *made])
    assert max(pairs.values()) == 1 and max(uses.values()) <= planner.REUSE
    assert min(r["index"] for r in made) == tasks.count() and len({r["index"] for r in made}) == len(made)
    assert all(own[r.anchor_id].language == ("tr" if r.cross_lingual == (r.question_language == "en") else "en") for r in made)
    digest = planner.prepare_run(tasks, f"{tmp_path}/run")
    assert planner.prepare_run(tasks.repartition(3), f"{tmp_path}/run") == digest
    with pytest.raises(ValueError):
        planner.prepare_run(more, f"{tmp_path}/run")


def test_settled_questions(spark):
    none = "cast(array() as array<string>)"
    rows = [("q1", "What is the tall tower of the north called today?", 3), ("q2", "Where?", 1), ("q3", "What is the tall tower of the north called today?", 2), ("q4", "When was it opened?", None), ("q5", "Who built it?", 4), ("q6", "bad", 0)]
    judged = spark.createDataFrame([(q, t) for q, t, _ in rows], "qa_id string, question string").withColumn("reasons", F.expr(f"if(qa_id = 'q6', array('x'), {none})")).withColumn("s", F.lit("a"))
    order = spark.createDataFrame([(q, i) for q, _, i in rows if i is not None], "qa_id string, task_index int")
    parts = questions.settle(judged, order, spark.createDataFrame([("a", 3), ("b", 2)], "s string, count long"), ["s"])
    ids = {k: sorted(r.qa_id for r in v.collect()) for k, v in parts.items() if k != "deficits"}
    assert ids == {"accepted": ["q2", "q3", "q5"], "overflow": ["q4"], "rejected": ["q1", "q6"]}
    assert [(r.s, r.deficit) for r in parts["deficits"].collect()] == [("b", 2)]
    told = {(r.dimension, r.key): r.n for r in questions.rejection_breakdown(parts["rejected"].withColumns({"question_language": F.lit("en"), "primary_type": F.lit("factual"), "provenance_passage_ids": F.expr(none), "source_document_ids": F.expr(none)})).collect()}
    assert told[("reason", "duplicate_question")] == 1 and told[("construction_stage", "validation")] == 2


def test_command_line_builds_questions(spark, corpus, tmp_path):
    docs, rows, _ = corpus
    docs.write.parquet(f"{tmp_path}/docs")
    rows.write.parquet(f"{tmp_path}/passages")
    assert main(["plan", f"{tmp_path}/passages", f"{tmp_path}/run", "--target", "4000"], spark) == 2
    tasks, _ = planner.plan_tasks(passages.evidence_candidates(rows), 30, 7, strict=False)
    planner.prepare_run(tasks, f"{tmp_path}/run")
    assert main(["questions", f"{tmp_path}/run", f"{tmp_path}/passages", f"{tmp_path}/docs"], spark) in (0, 2)
    assert spark.read.parquet(f"{tmp_path}/run/accepted").count() > 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.html").write_text("<html><body><h1>T</h1><p>text</p></body></html>")
    assert main(["extract", f"{tmp_path}/in/*", f"{tmp_path}/out"], spark) == 0
    (tmp_path / "in/b.pdf").write_bytes(b"%PDF-1.4 broken")
    assert main(["extract", f"{tmp_path}/in/*", f"{tmp_path}/out"], spark) == 2
    assert main(["review", f"{tmp_path}/passages", f"{tmp_path}/review", "--key", "passage_id", "--strata", "language", "--rate", "0.5", "--double"], spark) == 0
