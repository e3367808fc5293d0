"""Cross-tokenizer alignment: where the tokens of two tokenizers meet, and how often their ids are linked.

A text is cut before each space or line feed that follows a character other than white space, and before each full stop or
comma that follows an ASCII letter.  No pre-token of tokenizer A and no piece of tokenizer B spans such a place (the vocabulary is asked), so tokens, groups and links of a text are
those of its chunks, one after another.  A task encodes each new chunk once, many at a time, aligns all of them as arrays of byte
ends, and gathers texts from them; its memo of chunks is bounded.

Counts go through postings.  A batch of texts leaves, for every bucket of A ids, one packed block: the id pairs in order, how
many texts hold each, which, and how many times.  A bucket's blocks give its pairs' counts and each A id's highest (one row a
bucket, bounded by the vocabularies).  Blocks and counts then meet: both are shuffled by bucket, sorted, and read as one stream, the
counts first; each block gives its texts' sums at once and is dropped.  A bucket with many postings (a frequent id) is
split into salts by its measured size, and its counts are sent to each.  The sums return to their batch, one row a block, and are added up there.

Defined results: a null or empty text, and a text whose tokens' bytes of A or of B differ from a space and the text (as one with U+2581
does), has no tokens: zeros and an empty digest; a null doc_id passes through; rows that repeat a doc_id
are separate documents, also in the counts; texts of any length are taken whole; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _store, _workers

#: Buckets of A ids, and the packed bytes of postings that a salt of a bucket holds, about.
BUCKETS, SALT_BYTES = 64, 32 << 20
#: Characters and rows of a batch of texts; chunks that a task's memo keeps.
CHARS, ROWS, MEMO = 4 << 20, 1 << 16, 250_000
_CHUNK = re.compile(r"(?:[ \n]\s*|[.,])[^\sA-Za-z]*(?:[A-Za-z]+(?:[^\sA-Za-z.,][^\sA-Za-z]*)?|[^\S \n]\s*[^\sA-Za-z]*)*")
#: A pair is a * B_IDS + b.
B_IDS = 1 << 16
DOC_BITS = 17
_open: dict[tuple[str, str], Aligner] = {}


def _pack(x: np.ndarray, kind: str) -> bytes:
    """Numbers as compressed bytes, the bytes of one rank together."""
    raw = np.ascontiguousarray(x, kind).view(np.uint8).reshape(len(x), -1).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    n, wide = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(raw[8:], n * wide, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(wide, n).T).view(kind).ravel()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges start .. start + size, one range after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum())), sizes


def _summed(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each row of a flat array."""
    ends = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    at = np.cumsum(sizes)
    return ends[at] - ends[at - sizes]


class Ragged:
    """Rows of numbers of any length, appended many at a time."""

    def __init__(self, kind: str):
        self.data, self.starts, self.sizes = np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, data: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.data) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.data = np.concatenate([self.data, data.astype(self.data.dtype)])


class Aligner:
    """Chunks with what their two encodings have in common."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.cuts = not any(re.search("[^\\s▁][▁\n]|[A-Za-z][.,]", p) for p in pieces) and self._splits()
        # Chunks bring their own spaces.
        model = sentencepiece_model_pb2.ModelProto.FromString(self.b.serialized_model_proto())
        if not model.normalizer_spec.add_dummy_prefix:
            raise ValueError("tokenizer B puts no space before a text")
        model.normalizer_spec.add_dummy_prefix = False
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        letters = _byte_letters(ByteLevel.alphabet())
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.a_bytes = [b""] * size
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.b_bytes = [bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # An id as text with what follows it in a group, or after one.
        self.a_text, self.b_text = ([f"{i}{c}" for i in range(len(t)) for c in ",;"] for t in (self.a_bytes, self.b_bytes))
        self.clear()

    def _encode_a(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(chunks, add_special_tokens=False)]

    def _splits(self) -> bool:
        """Whether A splits texts as the cut needs: byte-level, by the usual expression, nothing added before."""
        import json

        known = json.loads(self.a.to_str())
        pre = known.get("pre_tokenizer") or {}
        return known.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", False) and not pre.get("add_prefix_space", True)

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []  # the groups of a chunk as text
        self.good, self.n_a, self.n_b, self.n_groups, self.n_links = (np.empty(0, np.int64) for _ in range(5))
        self.pairs = Ragged("<i8")

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(" " + text) if self.cuts else [" " + text]

    def learn(self, new: list[str]) -> None:
        """Encode and align chunks that are not known yet."""
        ids_a, ids_b = self._encode_a(new), self.b.encode(new, num_threads=1)
        raw = [x.encode() for x in new]
        (a, n_a), (b, n_b) = _flat(ids_a), _flat(ids_b)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        good = (_summed(self.a_size[a], n_a) == size) & (_summed(self.b_size[b], n_b) == size)
        whole = b"".join(raw)
        if not (good.all() and all(b"".join(map(t.__getitem__, i.tolist())) == whole for t, i in ((self.a_bytes, a), (self.b_bytes, b)))):
            good = np.array([b"".join(map(self.a_bytes.__getitem__, x)) == r and b"".join(map(self.b_bytes.__getitem__, y)) == r for x, y, r in zip(ids_a, ids_b, raw, strict=True)])
            (a, n_a), (b, n_b) = (_flat([x if ok else [] for x, ok in zip(ids, good, strict=True)]) for ids in (ids_a, ids_b))
        # Byte ends over all chunks, one after another: of a good chunk both encodings end at the same place.
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        first = np.searchsorted(end_b, end_a - self.a_size[a], "right")
        width = np.searchsorted(end_b, end_a, "left") - first + 1
        links = np.repeat(a, width) * B_IDS + b[_ranges(first, width)]
        close_a, close_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        n_groups = _summed(close_a, n_a)
        # The groups of all chunks as text: ids with their separators, cut at each group's end, then joined up to each chunk's.
        ends = "".join(map(self.a_text.__getitem__, (a * 2 + close_a).tolist())).split(";")
        also = "".join(map(self.b_text.__getitem__, (b * 2 + close_b).tolist())).split(";")
        groups = list(map("|".join, zip(ends[:-1], also[:-1], strict=True)))
        at = np.cumsum(n_groups) - n_groups
        for chunk, lo, n in zip(new, at.tolist(), n_groups.tolist(), strict=True):
            self.index[chunk] = len(self.texts)
            self.texts.append(groups[lo] if n == 1 else ";".join(groups[lo : lo + n]))
        self.pairs.add(links, _summed(width, n_a))
        for name, x in (("good", good), ("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", _summed(width, n_a))):
            setattr(self, name, np.concatenate([getattr(self, name), x.astype(np.int64)]))

    def align(self, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
        """The columns of every text, then the links of all: place of the text, pair, how many times; by bucket, pair and place."""
        if len(self.index) > MEMO:
            self.clear()
        split = [self.chunks(t) if t else [] for t in texts]
        if new := list(dict.fromkeys(c for s in split for c in s if c not in self.index)):
            self.learn(new)
        sizes = np.array([len(s) for s in split], np.int64)
        own = np.fromiter((self.index[c] for s in split for c in s), np.int64, int(sizes.sum()))
        place = np.repeat(np.arange(len(texts)), sizes)
        fine = np.bincount(place, self.good[own] == 0, len(texts)) == 0 if len(own) else np.ones(len(texts), bool)
        sums = {n: np.where(fine, np.bincount(place, getattr(self, n)[own], len(texts)) if len(own) else 0, 0).astype(np.int64) for n in ("n_a", "n_b", "n_groups", "n_links")}
        digests, at = [], 0
        for i, n in enumerate(sizes.tolist()):
            joined = n and fine[i]
            digests.append(hashlib.sha256(";".join(map(self.texts.__getitem__, own[at : at + n].tolist())).encode()).hexdigest() if joined else "")
            at += n
        keep = fine[place]
        own, place = own[keep], place[keep]
        # A chunk that a text repeats is looked at once.
        key, times = np.unique(place * len(self.texts) + own if len(own) else own, return_counts=True)
        place, own = key // max(len(self.texts), 1), key % max(len(self.texts), 1)
        width = self.pairs.sizes[own]
        pair = self.pairs.data[_ranges(self.pairs.starts[own], width)]
        key = (pair << DOC_BITS) | np.repeat(place, width)
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.repeat(times, width)[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.empty(0, np.int64)
        times = np.add.reduceat(times, starts) if len(key) else times
        key = key[starts]
        return sums | {"groups_sha256": digests}, key & ((1 << DOC_BITS) - 1), key >> DOC_BITS, times


def _byte_letters(alphabet: list[str]) -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 letters stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(i): i for i in shown} | {chr(256 + k): i for k, i in enumerate(i for i in range(256) if i not in set(shown))}
    if set(out) != set(alphabet):
        raise ValueError("tokenizer A's alphabet is not the byte-level one")
    return out


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _open:
        _open[a_path, b_path] = Aligner(a_path, b_path)
    _workers.hold("alignment", _open.clear)
    return _open[a_path, b_path]


HEAD = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())])
#: A batch's head (bucket -1: its documents as an Arrow stream) and its blocks: pairs (differences), texts a pair, the texts (differences), times.
BLOCKS = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("head", pa.binary()), ("pairs", pa.binary()), ("held", pa.binary()), ("places", pa.binary()), ("times", pa.binary())])
BLOCKS_DDL = "batch long, bucket int, head binary, pairs binary, held binary, places binary, times binary"


def _batches(columns: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """doc_id and text of a batch at a time."""
    ids, texts, chars = [], [], 0
    for b in columns:
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ids.append(i)
            texts.append(t.as_py())
            chars += len(texts[-1] or "")
            if chars >= CHARS or len(ids) >= ROWS:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def _streamed(table: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def _posted(docs: DataFrame, a_path: str, b_path: str, buckets: int) -> DataFrame:
    @_workers.lean("alignment")
    def run(columns: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, task = _aligner(a_path, b_path), TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(_batches(columns)):
            sums, place, pair, times = aligner.align(texts)
            head = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(sums[f.name], f.type) for f in list(HEAD)[1:])], schema=HEAD)
            rows = {f.name: [] for f in BLOCKS}
            bucket = (pair // B_IDS) % buckets
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for at, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                if lo == hi:
                    continue
                p, d, t = (x[order[lo:hi]] for x in (pair, place, times))
                starts = np.flatnonzero(np.diff(p, prepend=-1))
                step = np.diff(d, prepend=0)
                step[starts] = d[starts]
                block = (_pack(np.diff(p[starts], prepend=0), "<u8"), _pack(np.diff(starts, append=len(p)), "<u4"), _pack(step, "<u4"), _pack(t, "<u4"))
                for n, x in zip(BLOCKS.names, (0, at, None, *block), strict=True):
                    rows[n].append(x)
            for n, x in zip(BLOCKS.names, (0, -1, _streamed(head), None, None, None, None), strict=True):
                rows[n].append(x)
            rows["batch"] = [(task << 32) + k] * len(rows["bucket"])
            yield pa.RecordBatch.from_pydict(rows, schema=BLOCKS)

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS_DDL)


def _added(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(pairs, return_inverse=True)
    return own, np.bincount(at, counts, len(own)).astype(np.int64)


class _Sum:
    """Counts of pairs, added up now and then."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.loose = self.firm = 0

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((pairs, counts))
        self.loose += len(pairs)
        if self.loose > max(1 << 18, self.firm):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) != 1:
            self.parts = [_added(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
        self.firm, self.loose = len(self.parts[0][0]), 0
        return self.parts[0]


COUNTS = pa.schema([("bucket", pa.int32()), ("pairs", pa.binary()), ("held", pa.binary())])
COUNTS_DDL = "bucket int, pairs binary, held binary"
#: Pairs that a task of the first pass holds before it sends them on.
HELD = 1 << 21


def _sent(sums: dict[int, _Sum]) -> Iterator[pa.RecordBatch]:
    for bucket, own in sums.items():
        pairs, counts = own.total()
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([_pack(pairs, "<u8")], pa.binary()), pa.array([_pack(counts, "<u8")], pa.binary())], schema=COUNTS)


def _blocks(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        for row in zip(*(b.column(n) for n in names), strict=True):
            yield tuple(x.as_py() for x in row)


def _counted(posted: DataFrame) -> DataFrame:
    """One row a bucket: its pairs in order and the number of texts that hold each."""

    @_workers.lean()
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, _Sum] = {}
        for bucket, pairs, held in _blocks(batches, "bucket", "pairs", "held"):
            sums.setdefault(bucket, _Sum()).add(np.cumsum(_unpack(pairs, "<u8").astype(np.int64)), _unpack(held, "<u4").astype(np.int64))
            if sum(s.loose + s.firm for s in sums.values()) > HELD:
                yield from _sent(sums)
                sums = {}
        yield from _sent(sums)

    @_workers.lean()
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, _Sum()
        for bucket, pairs, held in _blocks(batches, "bucket", "pairs", "held"):
            if bucket != last and last is not None:
                yield from _sent({last: own})
                own = _Sum()
            last = bucket
            own.add(_unpack(pairs, "<u8").astype(np.int64), _unpack(held, "<u8").astype(np.int64))
        if last is not None:
            yield from _sent({last: own})

    parts = posted.filter("bucket >= 0").select("bucket", "pairs", "held").mapInArrow(part, COUNTS_DDL)
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(whole, COUNTS_DDL)


SUMS = pa.schema([("batch", pa.int64()), ("places", pa.binary()), ("best", pa.binary()), ("total", pa.binary())])


def _met(posted: DataFrame, counts: DataFrame, salts: DataFrame) -> DataFrame:
    """batch, places, best, total of every block: counts and blocks of a bucket in one sorted stream."""
    names = ("kind", "batch", "pairs", "held", "places", "times")

    @_workers.lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = count = top = None
        for kind, batch, p, held, places, times in _blocks(batches, *names):
            if kind == 0:
                pairs, count = (_unpack(x, "<u8").astype(np.int64) for x in (p, held))
                starts = np.flatnonzero(np.diff(pairs // B_IDS, prepend=-1))
                top = count == np.repeat(np.maximum.reduceat(count, starts), np.diff(starts, append=len(pairs)))
                continue
            own, n = np.cumsum(_unpack(p, "<u8").astype(np.int64)), _unpack(held, "<u4").astype(np.int64)
            at = np.searchsorted(pairs, own)
            step, times = _unpack(places, "<u4").astype(np.int64), _unpack(times, "<u4").astype(np.int64)
            # Within a pair the texts are differences.
            run_up, begins = np.cumsum(step), np.cumsum(n) - n
            place = run_up - np.repeat(run_up[begins] - step[begins], n)
            size = int(place.max()) + 1
            best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
            np.add.at(best, place, times * np.repeat(top[at], n))
            np.add.at(total, place, times * np.repeat(count[at], n))
            there = np.flatnonzero(total)
            cols = [_pack(np.diff(there, prepend=0), "<u4"), _pack(best[there], "<u4"), _pack(total[there], "<u8")]
            yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), *(pa.array([c], pa.binary()) for c in cols)], schema=SUMS)

    none = F.lit(None).cast("binary")
    of = F.broadcast(salts)  # one row a bucket
    left = counts.join(of, "bucket").select("bucket", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("batch"), "pairs", "held", none.alias("places"), none.alias("times"))
    right = posted.filter("bucket >= 0").join(of, "bucket").select("bucket", F.pmod(F.xxhash64("batch"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "batch", "pairs", "held", "places", "times")
    both = left.unionByName(right).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "kind")
    return both.select(*names).mapInArrow(run, "batch long, places binary, best binary, total binary")


def _gathered(posted: DataFrame, sums: DataFrame) -> DataFrame:
    """The documents of every batch with their blocks' sums added up."""
    schema = HEAD.append(pa.field("n_best", pa.int64())).append(pa.field("count_sum", pa.int64()))

    def done(head: pa.RecordBatch, best: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*head.columns, pa.array(best), pa.array(total)], schema=schema)

    @_workers.lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = best = total = None
        for raw, places, b, t in _blocks(batches, "head", "places", "best", "total"):
            if raw is not None:
                if head is not None:
                    yield done(head, best, total)
                head = pa.ipc.open_stream(raw).read_next_batch()
                best, total = np.zeros(len(head), np.int64), np.zeros(len(head), np.int64)
                continue
            at = np.cumsum(_unpack(places, "<u4").astype(np.int64))
            best[at] += _unpack(b, "<u4").astype(np.int64)
            total[at] += _unpack(t, "<u8").astype(np.int64)
        if head is not None:
            yield done(head, best, total)

    none = F.lit(None).cast("binary")
    heads = posted.filter("bucket < 0").select("batch", "head", none.alias("places"), none.alias("best"), none.alias("total"))
    both = heads.unionByName(sums.select("batch", none.alias("head"), "places", "best", "total"))
    dealt = both.withColumn("late", F.col("head").isNull()).repartition("batch").sortWithinPartitions("batch", "late").drop("late", "batch")
    return dealt.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def align_tokens(docs: DataFrame, a_path: str, b_path: str, buckets: int = BUCKETS, salt_bytes: int = SALT_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every document.

    a_path: a byte-level BPE file of ``tokenizers``; b_path: a ``sentencepiece`` model that puts a space before a text.
    """
    posted = _store.materialize(_posted(docs, a_path, b_path, buckets), "postings")
    size = F.sum(F.length("places") + F.length("times") + F.length("pairs") + F.length("held"))
    salts = posted.filter("bucket >= 0").groupBy("bucket").agg(F.greatest(F.lit(1), F.ceil(size / salt_bytes)).cast("int").alias("salts"))
    return _gathered(posted, _met(posted, _counted(posted), salts))
