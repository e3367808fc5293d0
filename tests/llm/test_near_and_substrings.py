import random
import re
from bisect import bisect_left
from collections import Counter
from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrand.llm import _graph, _words, near_text, substrings

from .conftest import edited, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.lists(st.text(alphabet="ab é日\t\n\x0b\x0c\r\x1c\x85", max_size=30), max_size=8), st.booleans())
@settings(max_examples=150, deadline=None)
def test_words(texts, sliced):
    column = pa.array(["x y", *texts])[1:] if sliced else pa.array(texts, pa.string())
    w = _words.Words(column)
    assert np.diff(w.bounds).tolist() == [len(WORD.findall(t)) for t in texts]
    flat = [x for t in texts for x in WORD.findall(t)]
    for a, b in combinations(range(len(flat)), 2):
        assert (w.hashes()[a] == w.hashes()[b]) == (flat[a] == flat[b])
    assert (w.hashes() == _words.Words(pa.array([" ".join(flat)])).hashes()).all()


def test_components(spark):
    rng = random.Random(3)
    for n, m in ((60, 40), (60, 200), (1, 0)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(100, 101), (101, 102), (102, 103), (103, 104), (104, 105)]
        root = {x: x for e in edges for x in e}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        got = dict(map(tuple, _graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
        assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert _graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_are_joined_by_the_driver(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(-40, 40), rng.randrange(-40, 40)) for _ in range(60)] + [(90 + i, 91 + i) for i in range(30)] + [(7, 7), (None, 7), (200, 200)]
    long = spark.createDataFrame(edges, "a long, b long")
    for frame in (long, long.select(*(F.col(c).cast("string").alias(c) for c in "ab")), long.select(*(F.unhex(F.sha2(F.col(c).cast("string"), 256)).alias(c) for c in "ab"))):
        by_driver, by_rounds = _graph.components(frame, few=1000), _graph.components(frame, few=10)
        assert by_driver.dtypes == by_rounds.dtypes
        assert sorted((str(x), str(y)) for x, y in by_driver.collect()) == sorted((str(x), str(y)) for x, y in by_rounds.collect())
    assert _graph.components(long.filter("a = b"), few=10).count() == 0


def test_few_pairs_are_few_tasks(spark):
    """A task of Python costs as much as some hundred pairs, so tasks follow the pairs, not the partitions of a shuffle."""
    texts = [(f"k{i}".encode(), np.arange(i, i + 40, dtype=np.uint64).tobytes()) for i in range(30)]
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("64", "false", "-1"), strict=True):
            spark.conf.set(k, v)
        pairs = spark.createDataFrame([(texts[i][0], texts[j][0]) for i, j in combinations(range(30), 2)], "a binary, b binary")
        made = near_text._verified(pairs, spark.createDataFrame(texts, "key binary, kmers binary"), 0.8)
        assert made._jdf.queryExecution().toRdd().getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        assert {(int(r.a[1:]), int(r.b[1:]), r.common, r.linked) for r in made.collect()} == {(i, j, max(0, 40 + i - j), j - i <= 4) for i, j in combinations(range(30), 2)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_bound_of_few_changes_nothing(spark, docs, monkeypatch):
    want = sorted(map(str, near_text.classes(docs).collect()))
    monkeypatch.setattr(near_text, "FEW", 0)
    assert sorted(map(str, near_text.classes(docs).collect())) == want


def shingles(text):
    """Runs of five words in order, each with the number of its occurrence."""
    w, seen, out = WORD.findall(text or ""), Counter(), []
    for i in range(max(1, len(w) - 4)):
        run = tuple(w[i : i + 5])
        out.append((run, seen[run]))
        seen[run] += 1
    return out


def in_order(a, b):
    """Labelled runs of both in one order: as each is unique, the longest increasing run of their places."""
    place, ends = {x: i for i, x in enumerate(b)}, []
    for i in (place[x] for x in a if x in place):
        k = bisect_left(ends, i)
        ends[k : k + 1] = [i]
    return len(ends)


def brute_classes(rows):
    """rows: (doc_id, text).  The class id of each row, by the alignment of all pairs."""
    runs, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if find(i) != find(j) and (m := in_order(runs[i], runs[j])) and m >= 0.8 * (len(runs[i]) + len(runs[j]) - m):
            root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d is not None, d or 0, least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_near_classes(docs, clashing, empty):
    want = brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    for frame in (docs, clashing):
        rows = near_text.classes(frame).collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.class_id) for r in rows) == want
    assert near_text.classes(empty).count() == 0


def test_chains_and_hot_groups(spark):
    rng, base = random.Random(5), prose(50, 300)
    rows = [(0, base)]
    for i in range(1, 400):  # near copies of a text, and of copies
        source = rows[rng.randrange(len(rows))][1] if i % 4 == 0 else base
        rows.append((i, edited(source, [rng.randrange(300) for _ in range(rng.randint(0, 9))])))
    rows += [(1000 + i, prose(1000 + i, 120)) for i in range(60)]
    got = near_text.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((True, r.doc_id, r.class_id) for r in got) == brute_classes(rows)


def test_hot_groups_make_few_comparisons(spark, monkeypatch):
    rng, base, boiler = random.Random(6), prose(60, 200), prose(61, 40)
    rows = [(i, edited(base, [rng.randrange(200) for _ in range(rng.randint(0, 5))])) for i in range(2000)]
    rows += [(10_000 + i, boiler + " " + prose(2000 + i, 45)) for i in range(2000)]
    made, verified = [], near_text._verified

    def counted(pairs, *more):
        made.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(near_text, "_verified", counted)
    got = {r.doc_id: r.class_id for r in near_text.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)).collect()}
    assert sum(made) <= 10 * len(rows), made
    sets = [set(shingles(t)) for _, t in rows[:2000]]
    reached, last = {0}, [0]  # by links, from the first copy on
    while last:
        last = [j for j in range(2000) if j not in reached and any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i in last[:40])]
        reached.update(last)
    assert all(got[i] == 0 for i in reached) and len(reached) > 1500 and all(got[10_000 + i] == 10_000 + i for i in range(2000))


def test_repeated_lines_count_by_occurrence(spark):
    line, rows = prose(80, 9), []
    for i in range(30):  # in small and large buckets
        body = prose(81 + i // 15, 150)
        rows.append((i, body + "\n" + "\n".join([line] * (40 + 5 * (i % 15)))))
    rows += [(100, prose(90, 60) + ("\n" + line) * 60), (101, prose(91, 60) + ("\n" + line) * 60), (102, prose(92, 90)), (103, prose(92, 90) + ("\n" + prose(92, 90)) * 2)]
    got = near_text.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_classes(rows)
    assert sorted((True, r.doc_id, r.class_id) for r in got) == want
    assert (True, 103, 103) in want and (True, 1, 0) in want


def test_texts_in_another_order_are_no_copies(spark):
    parts = [prose(300 + i, 60) for i in range(10)]
    rng = random.Random(8)
    rows = [(0, " ".join(parts)), (1, " ".join(parts[::-1])), (2, " ".join(rng.sample(parts, 10))), (3, " ".join([*parts[5:], *parts[:5]])), (4, " ".join([parts[9], *parts[:9]])), (5, " ".join(parts[:9]))]
    got = near_text.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((True, r.doc_id, r.class_id) for r in got) == brute_classes(rows)
    assert {r.doc_id: r.class_id for r in got} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0, 5: 0}


def test_random_edits_are_found(spark):
    """Insertions, deletions and replacements up to the limit, and moves beyond it, against all pairs."""
    rng = random.Random(12)
    rows = []
    for i in range(40):
        words = prose(400 + i, 200).split(" ")
        rows.append((len(rows), " ".join(words)))
        for _ in range(3):
            w = list(words)
            for _ in range(rng.randint(1, 9)):
                at = rng.randrange(len(w) - 1)
                kind = rng.randrange(4)
                w[at : at + 1] = [[], [w[at], "new"], ["other"], [w[at], w[at]]][kind]
            if rng.random() < 0.3:
                cut = rng.randrange(len(w))
                w = w[cut:] + w[:cut]
            rows.append((len(rows), " ".join(w)))
    got = near_text.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = brute_classes(rows)
    assert sum(g == w for g, w in zip(sorted((True, r.doc_id, r.class_id) for r in got), want, strict=True)) >= len(rows) - 1


def test_pairs_at_the_limit_share_a_band():
    rng = np.random.default_rng(4)
    lost = 0
    for _ in range(1000):
        a, fresh = rng.integers(0, 1 << 63, 180, dtype=np.uint64), rng.integers(0, 1 << 63, 40, dtype=np.uint64)
        b = np.insert(np.delete(a, rng.choice(180, 20, replace=False)), np.sort(rng.integers(0, 160, 20)), fresh[:20])
        assert near_text.aligned(a, b)
        lost += not (near_text.sketch(a) == near_text.sketch(b)).any()
        assert not (near_text.sketch(a) == near_text.sketch(a[::-1].copy())).any()
    assert lost <= 2


def test_alignment():
    a = np.arange(100, dtype=np.uint64)
    assert near_text.aligned(a, a) and near_text.aligned(a, np.r_[a[:95], a[:5] + 500])
    assert not near_text.aligned(a, np.r_[a[:80], a[:20] + 500]) and not near_text.aligned(a, a[:70])
    assert near_text.aligned(a, a[:80]) and not near_text.aligned(a, a[:79])
    long = np.arange(1000, dtype=np.uint64)
    assert near_text.compared(long, long[::-1].copy()) == (1000, False) and not near_text.aligned(long, np.random.default_rng(1).permutation(long))
    assert near_text.aligned(long, np.r_[long[100:], long[:100]]) and not near_text.aligned(long, np.r_[long[150:], long[:150]])
    assert near_text._increasing(np.array([3, 1, 2, 5, 4, 6])) == 4 and near_text._increasing(np.array([], int)) == 0


def test_occurrences_are_labelled():
    x = np.array([5, 7, 5, 5, 7, 9], np.uint64)
    got = near_text._labelled_runs(x)
    assert len(set(got.tolist())) == 6 and got[[0, 1, 5]].tolist() == [5, 7, 9]
    assert (near_text._labelled_runs(x[::-1].copy())[[1, 2]] == [7, 5]).all() and set(near_text._labelled_runs(x[:4]).tolist()) < set(got.tolist())


def brute_repeats(rows, window=20):
    """rows: (doc_id, text); rows that repeat both are one document."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, out = set(), {}
    for d, t in order:
        words = WORD.findall(t or "")
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone.update(range(i, i + window))
            seen.add(w)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[d, t] = (len(words), len(gone), sha256(kept.encode()).hexdigest())
    return sorted((d is not None, d or 0, *out[d, t]) for d, t in rows)


def spelled(rows):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def test_repeats(spark, docs, clashing, empty):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for frame in (docs, clashing):
        assert spelled(substrings.strip_repeats(frame).collect()) == brute_repeats(rows)
    assert substrings.strip_repeats(empty).count() == 0
    out = substrings.without_repeats(clashing)
    assert out.columns == clashing.columns
    left = {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()}
    assert (0, None) in left and (5, rows[5][1]) in left and not any(d == 6 for d, _ in left)
    assert out.filter("n_chars <> length(text)").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_repeats(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range([2, 30, 4000][seed])]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(6)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            lo = rng.randrange(len(p))
            words += p[lo : lo + rng.randint(1, 60)] if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 40))]
        rows.append((d, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert spelled(substrings.strip_repeats(frame).collect()) == brute_repeats(rows)


def brute_factors(frame):
    """Checks every factor of the frame's texts against the words themselves; returns the words they cover."""
    words = {(r.doc_id, r.tie): WORD.findall(r.text) for r in frame.select("doc_id", "text", substrings._tie().alias("tie")).collect()}
    covered = {}
    by_text = {}
    for f in substrings.factors(frame).collect():
        own, source = words[f.doc_id, f.tie], words[f.source_id, f.source_tie]
        assert f.length >= 20 and own[f.start : f.start + f.length] == source[f.source_start : f.source_start + f.length]
        assert (f.source_id, f.source_tie, f.source_start) < (f.doc_id, f.tie, f.start)
        covered.setdefault(f.doc_id, set()).update(range(f.start, f.start + f.length))
        by_text.setdefault((f.doc_id, f.tie), []).append((f.start, f.length))
    for parts in by_text.values():  # left to right, each begins behind the windows of the one before
        parts.sort()
        assert all(b[0] >= a[0] + a[1] - 19 for a, b in zip(parts, parts[1:], strict=False))
    return covered


def test_factors_are_places_of_equal_words(spark):
    rng = random.Random(9)
    passages = [[f"w{rng.randrange(3000)}" for _ in range(rng.randint(40, 120))] for _ in range(5)]
    rows = []
    for d in range(50):
        words = []
        for _ in range(4):
            p = rng.choice(passages)
            lo = rng.randrange(len(p) - 25)
            words += p[lo : lo + rng.randint(15, 120)] + [f"own{rng.randrange(9999)}" for _ in range(rng.randint(0, 30))]
        rows.append((d, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    covered = brute_factors(frame)
    want = {d: removed for _, d, _, removed, _ in brute_repeats(rows)}
    assert {d: len(covered.get(d, ())) for d, _ in rows} == want


def test_parse_is_greedy():
    span = lambda lo, hi, doc, src: {"lo": lo, "hi": hi, "src_doc": doc, "src_tie": 0, "src_lo": src}
    assert substrings.parse([]) == []
    # stretches that go on in their source are one factor
    assert substrings.parse([span(5, 9, 1, 50), span(10, 30, 1, 55)]) == [(5, 45, 1, 0, 50)]
    # of two sources the one that reaches further; then the rest of the other
    assert substrings.parse([span(0, 10, 1, 0), span(0, 30, 2, 7), span(25, 40, 3, 100)]) == [(0, 50, 2, 0, 7), (31, 29, 3, 0, 106)]
    assert substrings.parse([span(0, 4, None, 3), span(60, 61, 4, 0)]) == [(0, 24, None, 0, 3), (60, 21, 4, 0, 0)]


def test_common_phrase_sends_few_rows(spark):
    phrase = "the of and mo lin re"
    rows = [(i, prose(i, 30) + " " + phrase + " " + prose(5000 + i, 30)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(4)
    sent = substrings._index(frame.withColumn("tie", substrings._tie()), 20, 6)
    assert sent.groupBy("anchor").count().agg(F.max("count")).first()[0] <= 4 * 4
    assert spelled(substrings.strip_repeats(frame).collect()) == brute_repeats(rows)


def test_common_passage_sends_few_rows(spark):
    shared = prose(77, 50)
    frame = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit(shared), F.lit(" end "), F.col("id").cast("string")).alias("text")).coalesce(4)
    rows = frame.withColumn("tie", substrings._tie())
    sent = substrings._index(rows, 20, 6).filter("source is null and not mixed")
    assert sent.count() < 4 * 60 + 2000 * 8
    got = {r.doc_id: r.n_removed for r in substrings.strip_repeats(frame).collect()}
    assert got == {i: 0 if i == 0 else 51 for i in range(2000)}
