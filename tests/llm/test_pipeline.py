import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrand.llm import classifier, near_text, secrets, substrings

from .test_near_and_substrings import WORD, brute_classes, brute_repeats
from .test_secrets_and_rules import plain_spans


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output of every stage on the smallest tables."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    from lodestrand.llm import _store

    for name, stage in corpus_pipeline.STAGES:
        after = _store.materialize(stage(spark, docs, sf_dir), name)
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [s[0] for s in stages] == ["quality_classifier", "minhash_near_dedup", "substring_dedup", "secret_scan", "best_fit_packing"]
    for _, before, _, columns in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"] and before


def test_classifier_keeps_good_documents(stages, spark, sf_dir):
    _, before, after, _ = stages[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    good = [d for d, q in labels.items() if q]
    bad = [d for d, q in labels.items() if not q]
    assert sum(d in kept for d in good) >= 0.98 * len(good) and sum(d in kept for d in bad) <= 0.2 * len(bad)
    assert kept <= {r.doc_id for r in before}


def test_one_of_each_class_stays(stages):
    _, before, after, _ = stages[1]
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in brute_classes([(r.doc_id, r.text) for r in before])})


def test_repeats_are_gone(stages):
    _, before, after, _ = stages[2]
    want = {d: n for _, d, _, n, _ in brute_repeats([(r.doc_id, r.text) for r in before])}
    got = {r.doc_id: r for r in after}
    for r in before:
        assert got[r.doc_id].text == r.text if not want[r.doc_id] else r.doc_id not in got or len(got[r.doc_id].text.split()) == len(r.text.split()) - want[r.doc_id]


def test_secrets_are_redacted(stages):
    _, before, after, _ = stages[3]
    got = {r.doc_id: r for r in after}
    for r in before:
        spans = secrets.scan(r.text)[1]
        assert got[r.doc_id].text == (secrets.redact(r.text, spans) if spans else r.text) and got[r.doc_id].n_chars == len(got[r.doc_id].text)


def test_packing_holds_every_document(stages):
    _, before, after, _ = stages[4]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}


def test_packing_writes_the_ids_of_the_clean_texts(stages, tokenizer):
    from zlib import crc32

    from lodestrand.llm.tokenizer import encoder

    _, before, after, columns = stages[4]
    assert "ids" in columns and all(len(r.ids) == 4 * r.length and crc32(r.ids) == r.ids_crc32 for r in after)
    whole = {}
    for r in sorted(after, key=lambda r: (r.doc_id, r.piece)):
        whole[r.doc_id] = whole.get(r.doc_id, b"") + bytes(r.ids)
    texts = encoder(tokenizer, None).encode([r.text for r in before])
    assert whole == {r.doc_id: bytes(t) + b"\1\0\0\0" for r, t in zip(before, texts, strict=True)}


def test_stages_take_awkward_rows(spark, docs, clashing, empty, sf_dir):
    for frame in (docs, clashing, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf_dir)
            if name != "best_fit_packing":
                assert out.columns == frame.columns, name
            n = out.count()
            assert n <= frame.count() or name == "best_fit_packing"


def test_run(spark, sf_dir, stages):
    out = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, out.select("doc_id", "piece", "length").collect())) == sorted((r.doc_id, r.piece, r.length) for r in stages[-1][2])


def test_run_equals_a_plain_pipeline(spark, sf_dir, stages, tokenizer):
    """Texts and pieces of ``run`` from the classifier's choice on, by loops over whole texts in one process."""
    from zlib import crc32

    from tokenizers import Tokenizer

    kept = {r.doc_id for r in stages[0][2]}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.doc_id in kept}
    classes = {d: c for _, d, c in brute_classes(list(texts.items()))}
    texts = {d: t for d, t in texts.items() if classes[d] == d}
    seen = set()
    for d in sorted(texts):
        words, gone = WORD.findall(texts[d]), set()
        for i in range(len(words) - 19):
            run = tuple(words[i : i + 20])
            if run in seen:
                gone.update(range(i, i + 20))
            seen.add(run)
        if gone:
            texts[d] = " ".join(w for i, w in enumerate(words) if i not in gone)
            if len(gone) == len(words):
                del texts[d]
    want, n_ids, whole = set(), 0, Tokenizer.from_file(tokenizer)
    for d, t in texts.items():
        hidden = [False] * len(t)
        for _, a, b in plain_spans(t):
            hidden[a:b] = [True] * (b - a)
        clean = "".join("[SECRET]" if h and (i == 0 or not hidden[i - 1]) else "" if h else c for i, (c, h) in enumerate(zip(t, hidden, strict=True)))
        ids = np.array([*whole.encode(clean, add_special_tokens=False).ids, 1], "<u4")
        n_ids += len(ids)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.add((d, piece, start, len(part), crc32(part.tobytes())))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in placed.values():
        assert [o for o, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1].tolist()] and sum(n for _, n in own) <= 4096
    assert len(placed) <= -(-n_ids // 4096) + 2


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = classifier.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", "quality", "score").collect()
    assert len(rows) > 60 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_scores_have_no_leak_and_no_gap(spark, docs, clashing, empty):
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(19)], "doc_id long, quality int")
    assert classifier.quality_scores(docs, labels).filter("score is null").count() == 0
    assert classifier.quality_scores(clashing, labels).count() == docs.count()
    assert classifier.quality_scores(empty, labels).count() == 0
    assert classifier.quality_scores(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id or -1, r.score) for r in classifier.quality_scores(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(1)
    model = classifier.Model(np.zeros(classifier.N_STATS), np.ones(classifier.N_STATS), features=20_000)
    x = rng.standard_normal((12, classifier.N_STATS))
    waves = model.design(x)[:, :20_000]
    for i, j in combinations(range(12), 2):
        exact = np.exp(-((x[i] - x[j]) ** 2).sum() / (2 * classifier.WIDTH**2 * classifier.N_STATS))
        assert abs(waves[i] @ waves[j] - exact) < 0.04


def test_normal_equations_equal_brute_force():
    rng = np.random.default_rng(2)
    x, y, w = rng.standard_normal((300, 9)), rng.integers(0, 2, 300).astype(float), rng.uniform(0.5, 2, 300)
    x[:, -1] = 1
    parts = [classifier.normal_sums(x[a:b], y[a:b], w[a:b]) for a, b in ((0, 10), (10, 10), (10, 200), (200, 300))]
    got, shrink = classifier.ridge(sum(parts), 9, 0.01), np.sqrt(0.01 * 300) * np.diag([1.0] * 8 + [np.sqrt(1e-9)])
    root = np.sqrt(w)[:, None]
    want = np.linalg.lstsq(np.vstack([x * root, shrink]), np.r_[y * root[:, 0], np.zeros(9)], rcond=None)[0]
    assert np.allclose(got, want)


def test_isotonic_equals_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 9)
        total = np.array([rng.randint(1, 6) for _ in range(n)], float)
        good = np.array([rng.randint(0, int(t)) for t in total], float)
        x = np.arange(n, dtype=float)
        edges, values = classifier.isotonic(x, good, total)
        rate = lambda a, b: good[a : b + 1].sum() / total[a : b + 1].sum()
        want = [max(min(rate(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]  # the max-min formula
        assert np.allclose(sorted(set(np.round(want, 12))), sorted(set(np.round(values, 12)))) and (np.diff(edges) > 0).all()


def test_other_labels_are_none(spark, docs):
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(19)], "doc_id long, quality int")
    odd = labels.union(spark.createDataFrame([(1, 2), (2, -1), (3, None), (None, 1)], labels.schema))
    one, two = (sorted((r.doc_id or -1, r.score) for r in classifier.quality_scores(docs, x).collect()) for x in (labels, odd))
    assert one == two


def test_modules_are_whole():
    assert near_text.SIMILARITY == 0.8 and near_text.K == 5 and substrings.WINDOW == 20 and corpus_pipeline.ORACLE_SQL is None


def test_a_text_goes_to_the_classifier_once(spark, docs, sf_dir):
    """A worker's batch holds the columns of documents and no second copy of the text."""
    out = classifier.score_texts(docs, classifier.Model(np.zeros(classifier.N_STATS), np.ones(classifier.N_STATS)), "own")
    assert out.columns == [*docs.columns, "own"] and out.filter("own is null").count() == 0
    for frame in (out, corpus_pipeline.quality_classifier(spark, docs, sf_dir)):
        plan = frame._jdf.queryExecution().analyzed()
        while "MapInArrow" not in plan.nodeName():
            plan = plan.children().apply(0)
        assert plan.children().apply(0).output().size() == len(docs.columns)


def test_workers_drop_what_other_stages_left(tokenizer, monkeypatch):
    from lodestrand.llm import _workers
    from lodestrand.llm import tokenizer as module

    trims = []
    monkeypatch.setattr(_workers, "give_back", lambda: trims.append(len(module._open)))
    module.encoder(tokenizer).encode(["some words"])
    same, other = _workers.lean("tokenizer")(lambda batches: (len(module._open) for _ in batches)), _workers.lean()(lambda batches: (len(module._open) for _ in batches))
    assert list(same(iter([1]))) == [1] and list(other(iter([1, 2]))) == [0, 0] and trims == [1, 0]
    assert module.encoder(tokenizer).encode(["some words"])
