import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrand.llm import alignment, chat, hard_negatives, url_filters
from lodestrand.llm.queries import URL_RULES

from .conftest import cases

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
VECTORS = "vec_id long, label int, embedding array<float>, extra string"


def brute_negatives(rows):
    """rows: (vec_id, label, vector), all by loops over exact integers."""
    fit = [(i, v, label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in e]) for i, (v, label, e) in enumerate(rows) if v is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    fit = [r for r in fit if sum(x * x for x in r[3]) < 1 << 62]
    out = []
    for i, v, label, e in fit:
        if v % 100:
            continue
        scored = [(-sum(map(int.__mul__, e, f)), w, j, other) for j, w, other, f in fit if j != i and len(f) == len(e)]
        for ps, p, _, _ in sorted(x for x in scored if x[3] == label)[:5]:
            near = sorted(x for x in scored if x[3] != label and 30 * -ps <= 100 * -x[0] <= 90 * -ps)[:10]
            out += [(v, p, k, w, -ps, -s) for k, (s, w, _, _) in enumerate(near, 1)]
    return sorted(out)


def mined(frame, **more):
    got = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, **more).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


def awkward(rng):
    rows = [(i, rng.randrange(3), [rng.gauss(0, 0.2) + (i % 5 == 0) for _ in range(6)]) for i in range(0, 900, 3)]
    rows += [(rng.randrange(0, 4000, 50), rng.randrange(3), [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]) for _ in range(60)]  # repeated ids and vectors: ties
    rows += [(5000, None, [1.0] * 6), (5100, 1, None), (5200, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5300, 1, [float("nan")] + [0.0] * 5), (5400, 2, [float("inf")] + [0.0] * 5), (None, 1, [1.0] * 6)]
    rows += [(5500, 1, [0.5, 0.5]), (5501, 1, [0.5, 0.25]), (5502, 2, [0.25, 0.25]), (5600, 1, []), (5601, 1, []), (5602, 0, []), (5700, 1, [0.0] * 6)]
    rows += [(5800, 1, [3e6] * 6), (5801, 1, [2e6] * 6), (5802, 2, [1e6] * 6), (5900, 1, [3e38] * 6), (6000, 7, [0.1] * 6)]
    return rows


def test_scores_of_short_vectors_take_single_precision_and_stay_exact():
    rng = np.random.default_rng(3)
    for most, kind in ((200, np.float32), (40_000, np.int64), (1 << 27, np.int64)):
        x, y = (rng.integers(-most, most + 1, (9, 64)) for _ in range(2))
        got = hard_negatives._scores(x, y)
        assert got.dtype == kind and (got.astype(np.int64) == x @ y.T).all()
        for limit in (-hard_negatives.FAR, hard_negatives.FAR, int(got[0, 0])):
            assert ((got >= hard_negatives._limits(np.array([limit]), got)) == (x @ y.T >= limit)).all()


def test_vectors_are_coded_by_matrices(spark):
    rows = [(1, 0, [0.5, -0.001]), (2, 0, [0.5, None]), (3, 0, None), (4, 0, [float("nan"), 1.0]), (5, 0, []), (6, 0, [1e300, 1.0]), (7, 0, [8e6, 0.0, -3.0]), (8, None, [1.0])]
    coded = hard_negatives._coded(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").coalesce(1), "embedding", 256).collect()
    got = {r.vec_id: hard_negatives._matrix([bytes(r.code)], r.dims)[0].tolist() for r in coded}
    assert got == {1: [128, -1], 5: [], 7: [2_048_000_000, 0, -768]}
    assert [x.shape for _, x in hard_negatives.by_length(pa.array([[1.0], None, [2.0, 3.0], [4.0]]))] == [(2, 1), (1, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives(spark, seed, monkeypatch):
    rows = awkward(random.Random(seed))
    frame = spark.createDataFrame([(*r, "x") for r in rows], VECTORS).withColumn("row", F.lit("clash")).repartition(4)
    want = brute_negatives(rows)
    assert len(want) > 300 and mined(frame) == want
    for name, value in (("BLOCK", 7), ("ASKED", 5), ("FIRST", 1), ("SALTED", 20), ("HELD", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(frame) == want and mined(frame.limit(0)) == []


def test_lists_are_skipped(spark, monkeypatch):
    """Well parted clusters: far lists are left out, and the result is exact."""
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, i % 4, [c + rng.gauss(0, 0.02) for c in centres[i % 12]]) for i in range(1200)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    met, visited = [], hard_negatives._visited

    def counted(lists, asked, *more):
        met.append((lists.select("dims", "list").distinct().count() * asked.select(F.spark_partition_id()).distinct().count(), asked.count()))
        return visited(lists, asked, *more)

    monkeypatch.setattr(hard_negatives, "_visited", counted)
    assert mined(frame) == brute_negatives(rows)
    assert sum(n for _, n in met) < sum(n for n, _ in met)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (500, 16))
    c = hard_negatives.Centroids({16: x[:20].astype(float)})
    at, gap = c.nearest(x)
    c.radius[16] = np.array([gap[at == k].max(initial=0) for k in range(20)])
    _, lo, hi = c.bounds(x)
    dot = x @ x.T
    for j in range(500):
        assert (lo[:, at[j]] <= dot[:, j]).all() and (dot[:, j] <= hi[:, at[j]]).all()


def plain_alignment(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each text, by whole texts and loops over token pairs."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tokenizer.encode_special_tokens = True
    known = alignment.Aligner(A, B)
    made, counts, most = [], Counter(), defaultdict(int)
    for t in texts:
        a, b = (tokenizer.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)) if t else ([], [])
        raw = (" " + (t or "")).encode()
        if b"".join(known.a_bytes[i] for i in a) != raw or b"".join(known.b_bytes[i] for i in b) != raw:
            a, b = [], []
        ends = [np.cumsum([len(table[i]) for i in ids], dtype=int).tolist() for ids, table in ((a, known.a_bytes), (b, known.b_bytes))]
        spans = [[(e - len(table[i]), e, i) for i, e in zip(ids, own, strict=True)] for ids, own, table in ((a, ends[0], known.a_bytes), (b, ends[1], known.b_bytes))]
        links, j = [], 0
        for lo, hi, i in spans[0]:
            while spans[1][j][1] <= lo:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < hi:
                links.append((i, spans[1][k][2]))
                k += 1
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = []
        for lo, hi in zip([0, *cuts][: len(cuts)], cuts, strict=True):
            groups.append("|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in spans) if len(cuts) < 400 else None)
        made.append((a, b, cuts, links, groups))
        counts.update(set(links))
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for a, b, cuts, links, groups in made:
        text = "" if not a else None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((len(a), len(b), len(cuts), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), text))
    return out


ODD = ["a\t b", "x\t  b\n\n  c \n", "▁", "a ▁b", "<|endoftext|> </s> <s>", "日本語 テキスト　x   y", "\x1c \x1d a", "don't DON'T 123abc  ", "́ é", "a\r\nb\r\n", "\x00 nul\x00", " lead", "\n\nlead", "();\r\n };\r", "e.g. A.B.C, x,y ,z .q", "١٢٣ 😀😀", "same same same", "same same same"]


def aligned_rows(frame, **more):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in alignment.align_tokens(frame, A, B, **more).collect()]


@pytest.mark.parametrize("more", [{}, {"buckets": 3, "salt_bytes": 500}])
def test_alignment_of_tokens(spark, docs, clashing, empty, more, monkeypatch):
    rows = [(r[0], r[1]) for r in cases()] + [(100 + i, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, batch string").repartition(3)
    if more:
        monkeypatch.setattr(alignment, "HELD", 50)
        monkeypatch.setattr(alignment, "MEMO", 10)
        monkeypatch.setattr(alignment, "CHARS", 3000)
    want = Counter((i, *w) for (i, _), w in zip(rows, plain_alignment([t for _, t in rows]), strict=True))
    got = aligned_rows(frame, **more)
    known = {w[:-1]: w[-1] for w in want}
    assert Counter(g[:-1] for g in got) == Counter(w[:-1] for w in want.elements())
    assert all(known[g[:-1]] in (g[-1], None) for g in got)
    assert aligned_rows(empty) == [] and len(aligned_rows(clashing)) == docs.count()


def test_chunks_join_to_the_text_and_encode_alike():
    known = alignment.Aligner(A, B)
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "é", ".", ",", " ", "\n", "\t", "'s", "1", "-", "\x1c", "\u3000", "日", "\r"]) for _ in range(rng.randint(1, 40)))
        parts = known.chunks(text)
        assert "".join(parts) == " " + text
        ids = known.a.encode(" " + text, add_special_tokens=False).ids
        assert [i for e in known.a.encode_batch(parts, add_special_tokens=False) for i in e.ids] == ids
        assert [i for x in known.b.encode(parts) for i in x] == known.b.encode(" " + text)


def judged(spark, urls, **more):
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: r for r in url_filters.judge_urls(frame, url_filters.rule_table(spark, URL_RULES), **more).collect()}


def test_hosts_paths_and_rules(spark):
    urls = {
        "http://A.Example.ORG/es/1?x=/y#z": ("a.example.org", "/es/1", "example.org/es/", "block"), "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"), "x://example.org": ("example.org", "", None, "allow"),
        "http://b.org/es/1": ("b.org", "/es/1", "org/", "allow"), "http://q.com/fr/": ("q.com", "/fr/", "com/fr/", "allow"), "http://q.com/de/3#a?b": ("q.com", "/de/3", "com/de/", "block"), "http://notexample.org/es/1": ("notexample.org", "/es/1", "org/", "allow"),
        "http://q.com/frx": ("q.com", "/frx", None, "allow"), "nothing": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"), "://": ("", "", None, "allow"), "a?b://c.com/de/1": ("c.com", "/de/1", "com/de/", "block"),
        "http://Ünï.Com/DE/1": ("Ünï.com", "/DE/1", None, "allow"), "http://org/": ("org", "/", "org/", "allow"), "http://x.com#/de/": ("x.com", "", None, "allow"), "http://h.net/" + "a/" * 40 + "end": ("h.net", "/" + "a/" * 40 + "end", None, "allow"), "http://a://b.com/de/": ("a:", "//b.com/de/", None, "allow"),
    }
    got = judged(spark, list(urls))
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == list(urls.values())
    assert len(judged(spark, ["http://b.org/x"] * 50)) == 50
    assert url_filters.judge_urls(spark.createDataFrame([], "page_id long, url string"), url_filters.rule_table(spark, URL_RULES)).count() == 0
    assert {r.verdict for r in judged(spark, ["http://x.net/a/1", None]).values()} == {"allow"}


def test_longest_rule_of_many(spark):
    rng = random.Random(9)
    rules = [(".".join(rng.choice("ab") for _ in range(rng.randint(1, 3))), "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 4))), rng.choice(["allow", "block"])) for _ in range(150)]
    rules = list({r[:2]: r for r in rules}.values())
    urls = ["h://" + ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) + "/" + "".join(rng.choice("xyz/") for _ in range(rng.randint(0, 6))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in url_filters.judge_urls(frame, url_filters.rule_table(spark, rules)).collect():
        fit = [(h + p, v) for h, p, v in rules if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        best = max((len(x) for x, _ in fit), default=None)
        assert (r.rule, r.verdict if r.rule else None) in ([x for x in fit if len(x[0]) == best] or [(None, None)])


def test_templates(spark):
    """Ids become a wildcard, alike branches one, and what is mostly bad is rejected, for the unlabelled too."""
    urls, known = [], []
    for i in range(400):
        for section, bad in (("news", 0.05), ("blog", 0.05), ("spam", 0.95)):
            urls.append(f"http://x.net/{section}/{i}")
            if i % 4 == 0:
                known.append(("x.net", f"/{section}/{i}", 1, int(i / 4 % 20 < 20 * bad)))
    urls += [f"http://x.net/{i}-page-of-no-section/deep/{i}" for i in range(30)] + [f"http://y.net/spam/{i}" for i in range(50)]
    labelled = spark.createDataFrame(known, "host string, path string, labelled long, bad long")
    got = judged(spark, urls, labelled=labelled)
    by = defaultdict(set)
    for i, u in enumerate(urls):
        by[u.split("/")[2] + "/" + (u.split("/")[3] if "-page" not in u else "*")].add((got[i].template, got[i].verdict))
    assert by["x.net/spam"] == {("/spam/{n}", "block")} and by["y.net/spam"] == {("/spam/{n}", "allow")}
    assert by["x.net/news"] == by["x.net/blog"] == {("/{blog|news}/{n}", "allow")} and len(by["x.net/*"]) == 1
    purity = {r.template: r.purity for r in got.values() if r.host == "x.net"}
    prior = sum(k[3] for k in known) / len(known)
    assert purity["/spam/{n}"] == pytest.approx((95 + 5 * prior) / 105) and purity["/{blog|news}/{n}"] == pytest.approx((10 + 5 * prior) / 205)


def test_long_conversation_reads_back_in_proportion(spark):
    import time

    took = {}
    for n in (1000, 40_000):
        text = F.concat(F.lit("sömething [x] < said "), F.col("id").cast("string"))
        rows = spark.range(n, numPartitions=4).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
        began = time.time()
        r = chat.format_turns(rows).select(chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("said"), F.size(chat.read_turns(F.col("formatted"))).alias("n")).first()
        took[n] = time.time() - began
        assert r.n == n and r.said == "".join(f"sömething [x] < said {i}" for i in range(1, n, 2))
    assert took[40_000] < 15 + took[1000]
    cut = chat.format_turns(rows.limit(10)).select(chat.loss_text(F.col("formatted"), F.transform("loss_spans", lambda s: s.withField("end", s["end"] - 1))).alias("said")).first()
    assert cut.said == "".join(f"sömething [x] < said {i}"[:-1] for i in range(1, 10, 2))
