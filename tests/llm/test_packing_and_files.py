import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrand.llm import _store, packing, token_files
from lodestrand.llm.tokenizer import ChunkEncoder, encoder


def truth(tokenizer, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    return [(d, [*t.encode(x or "", add_special_tokens=False).ids, 1]) for d, x, *_ in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from(["It's, a Test.", "x<|endoftext|>.y", "İß", "12,5 $$$", "été."])), max_size=8))
@settings(max_examples=60, deadline=None)
def test_chunk_encoder_equals_library(texts):
    import public_tokenizers

    enc = encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [enc._ids(t) for t in texts]


def test_memo_bound_changes_nothing(tokenizer, monkeypatch):
    import lodestrand.llm.tokenizer as module

    monkeypatch.setattr(module, "MEMO", 5)
    enc = ChunkEncoder(tokenizer)
    texts = ["alpha beta, gamma. " * 3, "delta Epsilon zeta", "alpha omega!!"]
    assert [np.frombuffer(x, "<u4").tolist() for t in texts for x in enc.encode([t])] == [enc._ids(t) for t in texts]


def test_arrow_texts_are_encoded_by_their_distinct_words(tokenizer):
    enc = ChunkEncoder(tokenizer)
    assert enc.plain is not enc.tokenizer  # words skip the normalizer and the splitting

    class Counted(dict):
        asked = 0

        def get(self, k):
            self.asked += 1
            return super().get(k)

        def __getitem__(self, k):
            self.asked += 1
            return super().__getitem__(k)

    enc.memo = Counted(enc.memo)
    texts = ["Some words, some\tWords. " * 2000, None, "", "  words;\x0bwords\x85x\r\n", "naïve ÀÉÎ, straße×", "ſ ǅ K ŉ", "日本 e\u0301té <|endoftext|>,", "don't stop'..", "x" * 5000 + ", words"]
    for array in (pa.array(["skipped", *texts]).slice(1), pa.array(texts, pa.large_string())):
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(array)] == [enc._ids(t or "") for t in texts]
    assert enc.memo.asked < 200  # not once a word, of which there are 8,000
    assert enc.encode(pa.array([], pa.string())) == enc.encode([]) == [] and enc.encode(["", ""]) == [b"", b""]


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.sampled_from([0.0, 50.0, 95.0, 100.0]))
@settings(max_examples=80, deadline=None)
def test_block_round_trip(values, percentile):
    x = np.array(values, np.uint32)
    assert (token_files.unpack_block(token_files.pack_block(x, percentile), len(x)) == x).all()


def test_file_random_access():
    rng = np.random.default_rng(0)
    docs = [(None if i == 0 else i, rng.integers(0, 49_408, int(n), dtype=np.uint32).astype("<u4")) for i, n in enumerate(rng.integers(1, 900, 50))]
    f = token_files.IdFile(token_files.dump([(d, x.tobytes()) for d, x in docs], block=128))
    for k in random.Random(1).sample(range(50), 20):
        assert f.doc_ids[k] == docs[k][0] and (f.document(k) == docs[k][1]).all()
    with pytest.raises(ValueError, match="token-id file"):
        token_files.IdFile(b"x" * 64)


def test_files_hold_all_documents(spark, docs, clashing, empty, tokenizer):
    want = sorted(((d is not None, d or 0, crc(i), len(i)) for d, i in truth(tokenizer, docs.collect())))
    for frame in (docs, clashing):
        rows = token_files.read_ids(token_files.write_ids(frame, _store.new_path(spark, "t"), tokenizer, block=64, ids_a_file=500)).collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32, r.n_tokens) for r in rows) == want
        assert all(crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 for r in rows)
        rows.sort(key=lambda r: r.start)
        assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
        assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == sorted((r.doc_id is not None, r.doc_id or 0) for r in rows)
    assert token_files.read_ids(token_files.write_ids(empty, _store.new_path(spark, "t"), tokenizer)).count() == 0


def expand(patterns):
    return [[n for n, k in parts for _ in range(k)] for times, parts in patterns for _ in range(times)]


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=12))
@settings(max_examples=150, deadline=None)
def test_plan_uses_every_piece_once(counts):
    have = np.zeros(51, np.int64)
    for n, k in counts.items():
        have[n] = k
    bins = expand(packing.plan(have, 50))
    assert all(sum(b) <= 50 for b in bins)
    assert sorted(n for b in bins for n in b) == sorted(n for n, k in counts.items() for _ in range(k))


def one_by_one(lengths, capacity):
    """The same method without counts: one sequence at a time."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        own, gap = [], capacity
        for n in list(left):
            if n <= gap:
                own.append(n)
                left.remove(n)
                gap -= n
        while gap and len(own) > 1:
            small = min(own)
            pool = sorted([*left, small])
            best = max(((a + b, a, b) for i, a in enumerate(pool) for b in pool[:i] if a + b <= gap + small), default=(0, 0, 0))
            if best[0] <= small:
                break
            own.remove(small)
            left.append(small)
            for n in best[1:]:
                own.append(n)
                left.remove(n)
            left.sort(reverse=True)
            gap += small - best[0]
        bins.append(sorted(own))
    return bins


@given(st.lists(st.integers(1, 40), max_size=60))
@settings(max_examples=100, deadline=None)
def test_patterns_equal_single_steps(lengths):
    have = np.bincount(lengths, minlength=41) if lengths else np.zeros(41, int)
    assert len(packing.plan(have, 40)) <= 3 * 40
    assert abs(len(expand(packing.plan(have, 40))) - len(one_by_one(lengths, 40))) <= 1


def test_two_for_one():
    have = np.bincount([60, 30, 25, 14], minlength=101)
    bins = expand(packing.plan(have, 100))  # greedy: 60 + 30; two for the 30: 25 + 14
    assert sorted(map(sorted, bins)) == [[14, 25, 60], [30]]


def test_packing(spark, docs, clashing, empty, tokenizer):
    want = defaultdict(list)
    for d, ids in truth(tokenizer, docs.collect()):
        want[d].append(ids)
    for frame in (docs, clashing):
        packed = packing.pack_documents(frame, tokenizer, capacity=128, with_ids=True)
        rows = packed.collect()
        pieces = defaultdict(list)
        for r in rows:
            assert crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 and r.length <= 128 and r.start == 128 * r.piece
            pieces[r.doc_id].append((r.start, r.ids))
        for d, all_ids in want.items():
            got = sorted(pieces[d])
            assert sorted(x for _, x in got) == sorted(np.array(i[s : s + 128], "<u4").tobytes() for i in all_ids for s in range(0, len(i), 128))
        by = defaultdict(list)
        for r in rows:
            by[r.sequence_id].append((r.offset, r.length))
        for places in by.values():
            places.sort()
            assert [o for o, _ in places] == np.cumsum([0, *(n for _, n in places)])[:-1].tolist()
            assert sum(n for _, n in places) <= 128
        assert len(by) <= 1.01 * sum(r.length for r in rows) / 128 + 2
    for s in packing.sequences(packed).collect():
        assert len(s.ids) == 4 * s.n_ids
    assert packing.pack_documents(empty, tokenizer).count() == 0


def test_equal_lengths_share_all_salts(spark, tokenizer):
    many = spark.range(3000).selectExpr("id as doc_id", "'same text here' as text")
    rows = packing.pack_documents(many, tokenizer, capacity=20).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3000 and max(r.sequence_id for r in rows) == 599
