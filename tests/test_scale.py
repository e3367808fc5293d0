"""Steps whose cost must not follow the number of pairs, copies or rows of a batch: the same results by other means."""

import hashlib
import random

from lodestrand.operators import planner


def test_donors_under_hash_bounds_are_the_least_of_all(spark, monkeypatch):
    """Few hashes asked at first, then more: still the least hash of all donors, in the order of a parent's terms."""
    monkeypatch.setattr(planner, "SOUGHT", 1)
    monkeypatch.setattr(planner, "FURTHER", 3)
    rng = random.Random(5)
    rows = [(f"a{i}", f"d{i % 7}", f"text {i % 5}", [("entity", f"e{rng.randrange(3)}"), ("number", str(rng.randrange(40))), ("date", "2001")][: 1 + i % 3]) for i in range(300)]
    found = spark.createDataFrame(rows, "anchor_id string, document_id string, anchor_text string, mutation_terms array<struct<kind:string,value:string>>")
    # The first parent's first term has no donor anywhere: its second one is asked.
    rows.append(("x", "d9", "e0 e1 e2", [("entity", "e0"), ("number", "77"), ("other", "z")]))
    found = found.unionByName(spark.createDataFrame(rows[-1:], found.schema))
    parents = [("t-x", "x"), *((f"t{i}", f"a{i}") for i in range(25))]
    made = planner.donors(found, spark.createDataFrame(parents, "task_id string, anchor_id string"), 7).collect()
    of, want = {r[0]: r for r in rows}, {}
    for task, at in parents:
        _, document, text, terms = of[at]
        for position, (kind, source) in enumerate(terms):
            donors = [(hashlib.sha256(f"mutation-donor:7:{task}:{source}:{v}:{a}".encode()).hexdigest(), v, d) for a, d, _, ts in rows for k, v in ts if k == kind and d != document and v != source and v not in text]
            if donors:
                want[task] = (position, kind, source, *min(donors)[1:])
                break
    assert {r.task_id: (r.position, r.kind, r.source, r.value, r.donor_document_id) for r in made} == want
    assert want["t-x"][0] == 1


def test_choice_under_hash_bounds_is_that_of_all(spark, monkeypatch):
    """Many documents (settled under the first bound), then so few that a stratum is filled from their second passages on."""
    strata = planner._strata(planner.quota_plan(100))
    types = ["factual", "definition", "list_table", "comparison", "temporal"]
    for documents in (400, 6):
        rows = [(f"a{i}", f"p{i // 3}", f"d{i // 3 % documents}", ("en", "tr")[i // 3 % documents % 2], [types[i % 5], types[i // 7 % 5]]) for i in range(4000)]
        found = spark.createDataFrame(rows, "anchor_id string, passage_id string, document_id string, language string, compatible_types array<string>").repartition(3)
        picks = []
        for margin in (1, 10**9):  # the second one: no bound at all
            monkeypatch.setattr(planner, "MARGIN", margin)
            monkeypatch.setattr(planner, "FURTHER", 20)
            picks.append({tuple(r) for r in planner.choose(found, strata, 3).collect()})
        assert picks[0] == picks[1] and len(picks[0]) == sum(s["count"] for s in strata)


def test_a_plan_keeps_no_second_copy_of_its_candidates(spark):
    """A stored table is packed by Zstandard, and a choice reads it as it lies."""
    from pathlib import Path

    from lodestrand.operators import dedup

    found = dedup.stored(spark.createDataFrame([(f"a{i}", f"p{i}", f"d{i}", "en", ["factual"]) for i in range(40)], "anchor_id string, passage_id string, document_id string, language string, compatible_types array<string>"))
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("stored-*"))
    strata = [{"place": 0, "question_language": "en", "evidence_language": "en", "primary_type": "factual", "cross_lingual": False, "count": 5}]
    assert planner.choose(found, strata, 3).count() == 5 and set(folder.glob("stored-*")) == before
    assert before and all(".zstd." in p.name for p in Path(found.inputFiles()[0].removeprefix("file:")).parent.glob("*.parquet"))


def test_candidates_come_in_parts(spark, monkeypatch):
    """A task holds the anchors of a few passages at a time, with the same anchors."""
    from lodestrand.operators import passages

    text = "In 2001 the Northern Railway carried 400 tons of coal over the bridge of the town every week."
    rows = spark.createDataFrame([(f"p{i}", f"d{i}", f"d{i}", "en", 5, f"{text} {i}") for i in range(20)], "passage_id string, document_id string, variant_group_id string, language string, canonical_char_start int, text string").coalesce(1)
    want = sorted(passages.evidence_candidates(rows).collect())
    monkeypatch.setattr(passages, "PART", 3)
    assert sorted(passages.evidence_candidates(rows).collect()) == want and len(want) == 20


def test_pages_are_extracted_in_parts(spark, monkeypatch):
    """Markdown of a few pages at a time, a page that cannot be read among them."""
    from lodestrand.sources import extract

    rows = [(f"p{i}", "image/x" if i == 4 else "text/html", f"<html><body><h1>Page {i}</h1><p>Some text of page {i}.</p></body></html>".encode()) for i in range(9)]
    files = spark.createDataFrame(rows, "path string, mime string, content binary").coalesce(1)
    want = sorted(extract.extract(files).collect())
    monkeypatch.setattr(extract, "PART", 2)
    assert sorted(extract.extract(files).collect(), key=lambda r: r.path) == sorted(want, key=lambda r: r.path)
    assert len(want) == 9 and [r.path for r in want if r.error] == ["p4"]


def test_summaries_send_no_text_to_the_join_with_owners(spark):
    """What a text shows is found where it is read."""
    from lodestrand.operators import curate

    docs = spark.createDataFrame([(i, f"some words of text {i % 3}", "en") for i in range(9)], "doc_id long, text string, lang string")
    rows = curate.summary(docs)
    met, waiting = [], [rows._jdf.queryExecution().optimizedPlan()]
    while waiting:
        node = waiting.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        waiting += children
        if node.nodeName() == "Join":
            met += [c.output().apply(i).name() for c in children for i in range(c.output().size())]
    assert "content_hash" in met and "text" not in met
    assert [(r.documents, r.duplicates) for r in rows.collect()] == [(9, 6)]


def test_postings_are_made_in_parts(spark, monkeypatch):
    from lodestrand.operators import retrieval

    docs = spark.createDataFrame([(i, None if i == 4 else ["a", "b", "a"][: i % 4]) for i in range(11)], "pid long, w array<string>").coalesce(1)
    want = sorted(retrieval._postings(docs, ["a", "b"]).collect())
    monkeypatch.setattr(retrieval, "POSTED", 3)
    assert sorted(retrieval._postings(docs, ["a", "b"]).collect()) == want and [r.len for r in want] == [0, 1, 2, 3, 0, 1, 2, 3, 0, 1, 2]


def test_unicode_forms_are_made_in_parts(monkeypatch):
    import pyarrow as pa

    from lodestrand.functions import text

    monkeypatch.setattr(text, "PART", 2)
    assert text._by_parts(pa.array(["ﬁ", None, "", "a", "Ω"]), str.upper).to_pylist() == ["FI", None, "", "A", "Ω"]
    assert text._by_parts(pa.array([], pa.string()), str.upper).to_pylist() == []


def _read(spark) -> int:
    """Rows that all stages so far have read from files."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


def test_a_choice_reads_its_candidates_no_more_often_for_more_strata(spark):
    """Candidates of all strata are looked for at once; a round over them reads what was kept."""
    from lodestrand.operators import dedup

    types = ["factual", "definition", "list_table", "comparison", "temporal"]
    rows = [(f"a{i}", f"p{i // 3}", f"d{i // 3}", ("en", "tr")[i // 3 % 2], types) for i in range(30000)]
    found = dedup.stored(spark.createDataFrame(rows, "anchor_id string, passage_id string, document_id string, language string, compatible_types array<string>"))
    strata = planner._strata(planner.quota_plan(60))
    before = _read(spark)
    assert planner.choose(found, strata, 3).count() == sum(s["count"] for s in strata)
    assert len(strata) > 12 and _read(spark) - before < 5 * len(rows)


def test_mutations_ask_for_donors_of_hardly_more_parents_than_lack(spark, monkeypatch):
    """Each parent asked meets all terms: of 300 that could be, 100 are needed."""
    rows = [(f"a{i}", f"d{i}", f"text {i}", [("entity", f"e{i}")]) for i in range(300)]
    found = spark.createDataFrame(rows, "anchor_id string, document_id string, anchor_text string, mutation_terms array<struct<kind:string,value:string>>")
    tasks = spark.createDataFrame([(f"t{i}", "model", "en", "factual", f"a{i}") for i in range(300)], "task_id string, kind string, question_language string, qa_type string, anchor_id string")
    asked, plain = [], planner.donors
    monkeypatch.setattr(planner, "donors", lambda c, parents, *more: asked.append(parents.count()) or plain(c, parents, *more))
    made, issues = planner.mutations(found, tasks, {"en": 100}, 7, 0)
    assert made.count() == 100 and not issues and sum(asked) < 110


def test_what_is_cited_goes_to_the_checks_and_nothing_else(spark):
    """Passages, documents and candidates meet a plan's questions by broadcast, before any of them is shuffled."""
    from lodestrand.operators import passages, questions

    quote = questions.EVIDENCE
    rows = spark.createDataFrame([], f"qa_id string, primary_type string, evidence array<{quote}>")
    held = spark.createDataFrame([], passages.PASSAGE)
    docs = spark.createDataFrame([], "document_id string, text string, rights_state string, release_qa boolean, release_derived_text boolean")
    plan = questions.evidence_reasons(rows, held, docs, spark.createDataFrame([], passages.CANDIDATE))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 3 and plan.count("rightHint=(strategy=broadcast)") + plan.count("strategy=broadcast") >= 3


def test_near_duplicates_store_no_sets(spark):
    """What is kept on disk of long texts is less than the texts; the groups are those of the texts."""
    from pathlib import Path

    from lodestrand.operators import dedup

    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(4000)) for _ in range(120)]
    texts += [texts[0], texts[1] + " more words", " ".join(texts[2].split()[:3000])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dedup.shared(spark)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    held = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    before = held()
    got = {r.doc_id: (r.component, r.group_size) for r in dedup.near_duplicate_groups(docs).collect()}
    assert got == {i: (i, 1) for i in range(2, 123)} | {0: (0, 2), 120: (0, 2), 1: (1, 2), 121: (1, 2)}
    assert held() - before < sum(map(len, texts)) / 4
