import hashlib
import math
import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrand.llm import chat, pieces, queries, vectors


def brute_links(rows, limit=0.9):
    """vec_id -> (n_links, component_id) by all pairs."""
    ok = {}
    for k, (_, v) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.array(v, float)
            ok[k] = x / np.linalg.norm(x)
    links, root = {k: 0 for k in range(len(rows))}, list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(ok, 2):
        if len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= limit:
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), d), d)
    return sorted((d, links[k], least[find(k)]) for k, (d, _) in enumerate(rows))


def near_rows(n=300, d=24, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, d))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] + rng.standard_normal(d) * rng.choice([0.0, 0.1, 0.25, 0.45])
        rows.append((i, [float(np.float32(x)) for x in v]))
    return rows


def test_links_of_a_large_group_are_counted_in_full(spark):
    """Thousands of unequal vectors near one centre: tight ones agree in every key bit, loose ones do not all link."""
    rng = np.random.default_rng(11)
    for n, spread in ((2500, 1e-6), (1500, 0.3)):
        near = rng.standard_normal(24) + rng.standard_normal((n, 24)) * spread
        x = np.vstack([near, rng.standard_normal((300, 24))]).astype(np.float32).astype(float)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        want = (unit @ unit.T >= 0.9).sum(1) - 1
        got = vectors.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"))
        assert [r.n_links for r in sorted(got.collect())] == want.tolist() and want.max() > 1000


def test_windows_go_on_over_the_edges_of_tasks(spark):
    x = np.random.default_rng(2).standard_normal((40, 8))
    table = vectors.nodes(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), "embedding").cache()
    pairs = vectors._pairs(vectors._keyed(table.select("node", "vector"), 1), 48, -1.1)
    from lodestrand.llm import _graph

    assert {r.component for r in _graph.components(pairs).collect()} == {min(r.node for r in table.collect())}


def test_vectors_find_links(spark):
    rows = near_rows()
    rows += [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [None] * 24), (1004, [float("nan")] * 24), (1005, [float("inf")] * 24), (1006, [1.0] * 5), (1007, [1e-30] * 5), (1008, [1e30] * 5), (2, rows[2][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("x"))
    got = vectors.near_vectors(frame).collect()
    want = brute_links(rows)
    assert sum(g.n_links for g in got) >= 0.97 * sum(w[1] for w in want)
    truth = dict((w[0], w) for w in want)
    assert all(g.n_links <= truth[g.vec_id][1] for g in got)
    assert sum(g.component_id == truth[g.vec_id][2] for g in got) >= 0.97 * len(got)
    assert all(g.kept == (g.vec_id == g.component_id) for g in got)
    assert vectors.near_vectors(frame.limit(0)).count() == 0


@pytest.mark.parametrize("shared", [0.0, 0.6, 0.75])
def test_recall_where_vectors_share_a_direction(spark, shared):
    """6,000 vectors with a common direction of a squared weight and 500 planted pairs near the limit, by passes alone."""
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    common = unit(rng.standard_normal(64))
    draw = lambda n: unit((lambda z: z - (z @ common)[:, None] * common)(rng.standard_normal((n, 64))))
    x = np.sqrt(shared) * common + np.sqrt(1 - shared) * draw(6000)
    away = draw(500)
    away = unit(away - (away * x[:500]).sum(1)[:, None] * x[:500])
    near = 0.905 * x[:500] + np.sqrt(1 - 0.905**2) * away
    rows = [(i, v.astype(np.float64).tolist()) for i, v in enumerate(np.r_[x, near])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    # What all comparisons find is found; the windows alone find 0.95 of it.
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(frame).collect()}
    assert all(got[i] and got[6000 + i] for i in range(500))
    table = vectors.nodes(frame, "embedding").select("node", "vector").cache()
    mean = vectors.means(table)
    passes, enough = vectors.measured_passes(table, 6500, mean, 0.9, 12)
    assert enough == (shared < 0.7)  # where no affordable number of passes is enough, all are compared besides
    found = {frozenset((r.a, r.b)) for r in vectors._verified(vectors._pairs(vectors._keyed(table, passes, mean), 12, 0.9), table, 0.9).collect()}
    node = {r.vec_id: r.node for r in vectors.nodes(frame, "embedding").collect()}
    assert sum(frozenset((node[i], node[6000 + i])) in found for i in range(500)) >= 475
    assert passes >= vectors.passes_for(6500, window=12) and (shared or passes < 2 * vectors.passes_for(6500, window=12))


def test_all_links_are_a_forest_of_the_components(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((40, 16))
    x = centre[rng.integers(0, 40, 700)] + 0.12 * rng.standard_normal((700, 16))
    table = vectors.nodes(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), "embedding").cache()
    links = [(r.a, r.b) for r in vectors._all_links(table.select("node", "vector"), 0.9).collect()]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near, node = u @ u.T >= 0.9, [r.node for r in table.orderBy("vec_id").collect()]
    place = {n: i for i, n in enumerate(node)}
    root = list(range(700))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        assert near[place[a], place[b]]
        root[find(place[a])] = find(place[b])
    assert all(find(i) == find(j) for i, j in zip(*np.nonzero(near), strict=True)) and len(links) < 5 * 700


def test_small_tables_go_by_passes_as_large_ones_do(spark, monkeypatch):
    """800 vectors that share a direction, 200 with a partner near the limit: no table is small enough for another way unless asked for."""
    rng = np.random.default_rng(4)
    common, unit = np.eye(32)[0], lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(np.sqrt(3) * common + unit(rng.standard_normal((800, 32)) * (1 - common)))
    away = rng.standard_normal((200, 32))
    away = unit(away - (away * x[:200]).sum(1)[:, None] * x[:200])
    rows = [(i, v.tolist()) for i, v in enumerate(np.r_[x, 0.905 * x[:200] + np.sqrt(1 - 0.905**2) * away])]
    frame, want = spark.createDataFrame(rows, "vec_id long, embedding array<double>"), brute_links(rows)
    order = lambda f: sorted((r.vec_id, r.n_links, r.component_id) for r in f.collect())
    assert order(vectors.near_vectors(frame, passes=0)) == want
    monkeypatch.setattr(vectors, "_all_links", None)
    got = {r.vec_id: r.component_id == c for r, (_, _, c) in zip(sorted(vectors.near_vectors(frame, window=4).collect()), want, strict=True)}
    assert sum(got.values()) >= 0.98 * len(want)


def test_passes_follow_from_recall():
    assert [vectors.passes_for(n) for n in (1, 1000, 50_000, 5_000_000)] == sorted(vectors.passes_for(n) for n in (1, 1000, 50_000, 5_000_000))
    assert vectors.passes_for(50_000) < 30 and vectors.passes_for(50_000, recall=0.9) < vectors.passes_for(50_000)


def test_recall_at_the_limit(spark):
    """Pairs right at the limit among many others that are alike to nothing."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((300, 64))
    side -= (side * base[:300]).sum(1, keepdims=True) * base[:300]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    close = 0.902 * base[:300] + np.sqrt(1 - 0.902**2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, close]))]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("vec_id >= 3000").collect()
    assert sum(r.component_id == r.vec_id - 3000 for r in got) >= 0.97 * 300


def test_common_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(500)] + [(1000 + i, [float(i % 7 - 3), 1.0, -1.0, 0.5]) for i in range(50)]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[i].n_links == 499 and got[i].component_id == 0 for i in range(500))
    assert {d: (r.n_links, r.component_id) for d, r in got.items()} == {d: (n, c) for d, n, c in brute_links(rows)}


# Chat


@given(st.text(alphabet="\\<>[]elbs/INST|turnsayd \n日", max_size=60))
@settings(max_examples=30, deadline=None)
def test_escape_is_reversible_in_plain(text):
    escaped = text
    for a, b in chat._CODES:
        escaped = escaped.replace(a, b)
    assert "<" not in escaped and "[" not in escaped
    for a, b in chat._CODES[::-1]:
        escaped = escaped.replace(b, a)
    assert escaped == text


def conversations():
    rng = random.Random(0)
    bits = ["</s>", "[INST]", "\\", "\\l", "\\e", "<|end|>", "<|turn|>", "<|says|>", "a", " ", "\n", "日", "<", "["]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "human", None, "ro<le"]), rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))])) for c in range(80) for t in range(rng.randint(1, 6))]
    return [*rows, rows[0], (0, 0, "user", "tie"), (0, None, "assistant", "first"), (None, 0, "user", "no id")]


def digest(rows):
    rows = [(r or "", t or "") for r, t in rows]
    loss = "".join(t for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_query(spark, tmp_path):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("layout", F.lit("x")).withColumn("record", F.lit(1))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op5_chat_format(spark, str(tmp_path)).collect()}
    by = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r, x))
    by[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert got == {c: digest(own) for c, own in by.items()}


RECORDS = {
    '{"role":"user","text":"q"}': ("turn", [("user", "q")]),
    '{"content":"q","role":"system"}': ("message", [("system", "q")]),
    '{"from":"gpt","value":"a"}': ("said", [("assistant", "a")]),
    '{"messages":[{"role":"user","content":"q"},{"content":null,"role":"assistant"}]}': ("messages", [("user", "q"), ("assistant", "")]),
    '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}': ("conversations", [("user", "q"), ("assistant", "a")]),
    '[{"role":"user","content":"q"}]': ("bare_messages", [("user", "q")]),
    '{"prompt":"q","completion":"a"}': ("prompt_completion", [("user", "q"), ("assistant", "a")]),
    '{"instruction":"do","input":"this","output":"done"}': ("instruction_input", [("user", "do\n\nthis"), ("assistant", "done")]),
    '{"instruction":"do","input":"","output":"done"}': ("instruction_input", [("user", "do"), ("assistant", "done")]),
    '{"system":"s","prompt":"q","completion":"a"}': ("system_prompt", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    '{"question":"q","answer":7}': ("question_answer", [("user", "q"), ("assistant", "7")]),
    '{"role":"user","text":"q","id":7,"tags":["x"]}': ("turn+", [("user", "q")]),
    '{"name":"n","messages":[{"role":"user","content":"q","name":"u"},{"content":"a","role":"assistant","tool_calls":[]}]}': ("messages+", [("user", "q"), ("assistant", "a")]),
    '{"prompt":"q","completion":"a","system":"s","source":{"url":"u"}}': ("system_prompt+", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    '{"unknown":{"deep":[1]}}': (None, None),
    "null": (None, None),
}


def test_layouts(spark):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(RECORDS)], "id int, j string").select("id", F.parse_json("j").alias("record"))
    got = {r.id: r for r in chat.canonical_turns(rows).collect()}
    for i, (layout, turns) in enumerate(RECORDS.values()):
        assert got[i].layout == layout and (got[i].turns if turns is None else [tuple(t) for t in got[i].turns]) == turns, list(RECORDS)[i]
    assert {r.j for r in chat.unread(chat.canonical_turns(spark.createDataFrame([(r,) for r in RECORDS], "j string").withColumn("record", F.parse_json("j")))).collect()} == {'{"unknown":{"deep":[1]}}', "null"}


def test_chat_uses_no_python(spark, sf_dir):
    plan = queries.op5_chat_format(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("EvalPython|MapInPandas|MapInArrow|PythonUDF|Cartesian", plan)


# Pieces


def all_paths(lattice, word):
    """Every segmentation: (score, ids)."""
    if not word:
        return [(0.0, ())]
    out = []
    for b in range(1, len(word) + 1):
        for a, ids, s in lattice.edges(word, b):
            if a == 0:
                out += [(s + s2, ids + i2) for s2, i2 in all_paths_from(lattice, word, b)]
    return out


def all_paths_from(lattice, word, at):
    if at == len(word):
        return [(0.0, ())]
    out = []
    for b in range(at + 1, len(word) + 1):
        out += [(s + s2, ids + i2) for a, ids, s in lattice.edges(word, b) if a == at for s2, i2 in all_paths_from(lattice, word, b)]
    return out


@given(st.text(alphabet="theing日ß a", min_size=1, max_size=9))
@settings(max_examples=80, deadline=None)
def test_word_search_is_exact(text):
    lattice = _lattice()
    for word in pieces.normalised_words(text):
        want = sorted((-s for s, _ in all_paths(lattice, word)))[:6]
        got = lattice.search(word)
        assert [-s for s, _ in got] == pytest.approx(want) and len({i for _, i in got}) == len(got)


_held = []


def _lattice():
    if not _held:
        _held.append(pieces.Lattice.load(queries.tokenizer_path("piece_bpe_32k.model"), 6))
    return _held[0]


@given(st.text(alphabet="then ing日", max_size=12))
@settings(max_examples=60, deadline=None)
def test_text_search_is_exact(text):
    lattice = _lattice()
    sums = [0.0]
    for word in pieces.normalised_words(text):
        sums = sorted(a + s for a in sums for s in sorted((s for s, _ in all_paths(lattice, word)), reverse=True)[:6])[::-1][:6]
    got = lattice.encode(text)
    assert [s for s, _ in got] == pytest.approx(sorted(sums, reverse=True)[:6])
    decoder = pieces.Decoder(lattice)
    assert all(decoder.decode(ids) == pieces.normalised(text) for _, ids in got) and len({tuple(i) for _, i in got}) == len(got)


def test_long_words_and_memo(monkeypatch):
    lattice = _lattice()
    assert len(lattice.encode("a" * 20_000)) == 6
    monkeypatch.setattr(pieces, "MEMO", 3)
    assert lattice.encode("some words to forget and some to keep") == pieces.Lattice.load(queries.tokenizer_path("piece_bpe_32k.model"), 6).encode("some words to forget and some to keep")


def test_piece_query(docs, clashing, empty):
    model = queries.tokenizer_path("piece_bpe_32k.model")
    for frame in (docs, clashing):
        out = pieces.encode_pieces(frame, model, with_ids=True)
        rows = out.collect()
        assert all(r.round_trip for r in rows) and len(rows) == docs.count() and all(r.scores == sorted(r.scores, reverse=True) for r in rows)
        back = pieces.decode_pieces(out.select("doc_id", out.ids[0].alias("ids")), model)
        want = sorted(pieces.normalised(r.text or "") for r in docs.collect())
        assert sorted(r.text for r in back.collect()) == want
    assert pieces.encode_pieces(empty, model).count() == 0


def test_round_trip_is_told_of_every_text():
    lattice = pieces.Lattice({pieces.MARK: (300, -1.0), "ab": (301, -1.0), "c": (302, -1.0)}, list(range(256)))
    lattice.raw[301] = b"?"
    assert [lattice.segment(t)[2] for t in ("c", "ab c", "ab c", "c ab", "c", "cab")] == [True, False, False, False, True, False]
    lattice.memo.clear()
    assert [lattice.segment(t)[2] for t in ("ab", "ab", "")] == [False, False, True]


def test_words_together_equal_one_at_a_time(monkeypatch):
    rng = random.Random(5)
    lattice, path = _lattice(), queries.tokenizer_path("piece_bpe_32k.model")
    words = {"".join(rng.choices("theingasor.,%Zß日é0\x00\U0001f600", k=rng.randint(1, 14))) for _ in range(3000)} | {"a" * 200, "日" * 500, "x" * 41 + "日b", "the" * 30}
    words |= {"".join(rng.choices(["the", "ing", "Wort", "é", "ata", "."], k=rng.randint(1, 4))) for _ in range(500)}
    want = {w: lattice.best(pieces.MARK + w) for w in words}
    for long, run in ((40, 1 << 17), (4, 300), (1, 50)):
        monkeypatch.setattr(pieces, "LONG", long)
        monkeypatch.setattr(pieces, "RUN", run)
        own, alone = pieces.Lattice.load(path, 6), []
        own._one_by_one = lambda w, own=own, alone=alone: (alone.extend(w), pieces.Lattice._one_by_one(own, w))
        own.know([list(words)])
        assert len(own.memo) == len(words) and (long < 40 or len(alone) <= 4)
        for w, row in own.memo.items():
            got = own.ids.held[own.ends.held[row] : own.ends.held[row + 1]].tobytes()
            assert (got, own.score.held[row], own.loss.held[row], own.same.held[row]) == want[w], w
    fresh = pieces.Lattice.load(path, 6)
    texts = [" ".join(rng.choices(sorted(words), k=rng.randint(0, 30))) for _ in range(60)]
    split = [pieces.split_words(t) for t in texts]
    fresh.know(split)
    assert list(fresh.chains(split)) == [lattice.segment(t) for t in texts]
    assert all(len(b"".join(map(fresh.raw.__getitem__, np.frombuffer(p[0], "<u4").tolist()))) == len(" ".join(["", *w]).encode()) + 2 * len(w) for w, (_, p, _) in zip(split, fresh.chains(split), strict=True))


def test_together_tells_what_is_not_spelt(monkeypatch):
    monkeypatch.setattr(pieces, "FEW", 1)
    lattice = pieces.Lattice({pieces.MARK: (300, -1.0), "ab": (301, -1.0), "c": (302, -1.0)}, list(range(256)))
    lattice.raw[301] = b"??"
    assert [lattice.segment(t)[2] for t in ("c", "ab c", "c ab", "c", "cab x", "x c", "")] == [True, False, False, True, False, True, True]
