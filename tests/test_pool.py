import random

import pytest

from lodestrand.operators import dedup, pool


def asked(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(12, 30))) for _ in range(25)]
    out = []
    for i in range(n):
        w = rng.choice(texts).split(" ")
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append((i, " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    return [*out, (n, ""), (n + 1, "two words"), (n + 2, ""), (n + 3, None)]


def told(frame):
    return sorted((r.key, r.reason) for r in frame.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_give_the_rows_of_one(spark, tmp_path, seed, monkeypatch):
    rows = asked(seed)
    frame = spark.createDataFrame(rows, "key long, text string").repartition(3)
    want = told(dedup.question_filter(frame))
    assert {r for _, r in want} == {None, "duplicate_question", "near_duplicate_question"}
    base = f"file://{tmp_path}/pool"
    parts = [frame.filter(f"key >= {lo} and key < {hi}") for lo, hi in ((0, 50), (50, 51), (51, 51), (51, 1000))]
    got = []
    for b, part in enumerate(parts):
        if b == 3:  # dies before its decisions are committed, and is sent again
            with monkeypatch.context() as m, pytest.raises(RuntimeError):
                m.setattr(pool, "question_filter", lambda *a: (_ for _ in ()).throw(RuntimeError()))
                pool.add(base, b, part)
            part.limit(5).selectExpr("key as k", "array('x') as s", "'h' as h").write.parquet(f"{base}/accepted/batch=3")
        got += told(pool.add(base, b, part))
    assert sorted(got) == want
    assert sorted(x for b, part in enumerate(parts) for x in told(pool.add(base, b, part.limit(0)))) == want  # stored decisions
    with pytest.raises(ValueError):
        pool.add(base, -1, parts[0])


def test_a_batch_reads_the_slots_of_its_hashes(spark, tmp_path):
    base = f"file://{tmp_path}/pool"
    pool.add(base, 0, spark.createDataFrame(asked(3), "key long, text string"))
    frame = spark.createDataFrame([(500, "one new question about nothing else at all")], "key long, text string")
    slots = {r.slot for r in pool._hashes(frame.selectExpr("key as k", "array('a', 'b') as s", "text as h")).select("slot").collect()}
    assert 1 <= len(slots) <= 5
    assert told(pool.add(base, 1, frame)) == [(500, None)]
    assert len(list((tmp_path / "pool/index/batch=1").glob("slot=*"))) <= 5


def test_a_question_is_hashed_once_and_only_neighbours_wait(spark, tmp_path, monkeypatch):
    made, states = [], []
    for module in (dedup, pool):
        monkeypatch.setattr(module, "sha_signature", lambda s, of=dedup.sha_signature: made.append(1) or of(s))
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(1, words), (2, "Is it open?"), (3, f"{words} more"), (4, "is it  open?"), (5, "And then?")]
    for batch in (0, 1):
        told = pool.add(str(tmp_path), batch, spark.createDataFrame([(k + 10 * batch, t) for k, t in rows], "key int, text string"))
        want = {4: "duplicate_question"} if not batch else {11: "duplicate_question", 12: "duplicate_question", 14: "duplicate_question", 15: "duplicate_question"}
        got = {r.key: r.reason for r in told.collect()}
        assert len(got) == 5 and {k: r for k, r in got.items() if k % 10 != 3 and r} == want and (not batch or got[13])
    assert len(made) == 2
    monkeypatch.setattr(dedup, "cut", lambda df: states.append(df.columns) or df)
    kept = dedup.ordered_filter(spark.createDataFrame([(1,), (2,), (3,)], "key int"), spark.createDataFrame([], "a int, b int"))
    assert sorted(map(tuple, kept.collect())) == [(1, True), (2, True), (3, True)] and len(states) == 2
