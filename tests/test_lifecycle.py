import threading

import pytest
from pyspark.sql import functions as F

from lodestrand.operators import lifecycle


def test_two_writers_one_wins(spark, tmp_path):
    base, won, lost = f"file://{tmp_path}/v", [], []

    def write(i):
        try:
            won.append((i, lifecycle.commit(spark, base, {"t": spark.range(i + 1), "u": spark.range(3)}, 0, by=str(i))))
        except lifecycle.Conflict:
            lost.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 4 and won[0][1] == 1
    assert lifecycle.current(spark, base, "t").count() == won[0][0] + 1 and lifecycle.entry(spark, base, 1)["by"] == str(won[0][0])
    assert len(list((tmp_path / "v/data").iterdir())) == 1 and [p.name for p in (tmp_path / "v/log").iterdir() if not p.name.startswith(".")] == ["0" * 19 + "1"]
    with pytest.raises(lifecycle.Conflict):
        lifecycle.commit(spark, base, {"t": spark.range(9)}, 5)
    assert lifecycle.commit(spark, base, {"t": spark.range(7)}, 1) == 2
    assert lifecycle.current(spark, base, "t").count() == 7 and lifecycle.current(spark, base, "t", 1).count() == won[0][0] + 1
    with pytest.raises(FileNotFoundError):
        lifecycle.current(spark, base, "t", 3)
    with pytest.raises(FileNotFoundError):
        lifecycle.current(spark, f"{base}/none", "t")


def test_entry_is_created_once(spark, tmp_path):
    base, done = f"file://{tmp_path}/e", []
    _, p = lifecycle._fs(spark, f"{base}/log")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    threads = [threading.Thread(target=lambda i=i: done.append((i, lifecycle._created(spark, base, 1, {"tables": {}, "by": i})))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    (winner,) = [i for i, ok in done if ok]
    assert lifecycle.entry(spark, base, 1)["by"] == winner


def reviewed(spark, change=None):
    sample = [(q, s) for q in ("q1", "q2") for s in "AB"]
    reviews = [[q, s, f"r{s}", True, False, True, True] for q, s in sample]
    if change:
        change(sample, reviews)
    schema = "qa_id string, reviewer_slot string, reviewer_id string, clarity boolean, correctness boolean, evidence_sufficiency boolean, language_quality boolean"
    return spark.createDataFrame(sample, "qa_id string, reviewer_slot string"), spark.createDataFrame(reviews, schema)


@pytest.mark.parametrize(
    ("change", "issues"),
    [
        (None, {}),
        (lambda s, r: r.append(list(r[0])), {"reviews_do_not_match_assignments": 1}),
        (lambda s, r: r.pop(), {"reviews_do_not_match_assignments": 1, "reviewers_not_two": 1}),
        (lambda s, r: r.append(["q9", "A", "rA", True, True, True, True]), {"reviews_do_not_match_assignments": 1, "reviewers_not_two": 1}),
        (lambda s, r: r[0].__setitem__(2, "rB"), {"reviewers_not_two": 1}),
        (lambda s, r: r[0].__setitem__(2, None), {"reviewer_unnamed": 1}),
        (lambda s, r: r[3].__setitem__(5, None), {"review_incomplete": 1}),
        (lambda s, r: (s.pop(), r.pop()), {"item_lacks_a_slot": 1, "reviewers_not_two": 1}),
    ],
)
def test_review_issues(spark, change, issues):
    assert {r.issue: r["items"] for r in lifecycle.review_issues(*reviewed(spark, change)).collect()} == issues


def test_promotion_needs_gates_and_reviews(spark, tmp_path):
    base = f"file://{tmp_path}/p"
    gates = spark.createDataFrame([("balance", "pass"), ("kappa", "fail")], "gate string, status string")
    rows = {"accepted": spark.range(4)}
    with pytest.raises(lifecycle.NotReady) as e:
        lifecycle.promote(spark, base, rows, gates, *reviewed(spark, lambda s, r: r.pop()), 0, ["balance", "kappa", "count"])
    assert e.value.issues == ["gate count: missing", "gate kappa: fail", "reviewers_not_two: 1", "reviews_do_not_match_assignments: 1"]
    assert lifecycle.entries(spark, base) == []
    assert lifecycle.promote(spark, base, rows, gates.withColumn("status", F.lit("pass")), *reviewed(spark), 0, run="r1") == 1
    assert lifecycle.current(spark, base, "accepted").count() == 4
