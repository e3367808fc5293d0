"""Best-two-fit packing of documents into sequences.

A document's ids, with the end id, are cut into pieces of at most ``capacity``.  Pieces of one length are alike, so the
plan is made on the histogram of lengths (at most ``capacity`` counts, whatever the corpus): fill a sequence greedily with
the longest pieces that fit; then, as long as it helps, replace its smallest piece by two unpacked pieces that fill the
widened gap more tightly; repeat the finished pattern as often as the counts allow.  A pattern uses up a length or
leaves too little of it for another turn, so there are few thousand patterns however many sequences there are.

A piece finds its place by its rank among the pieces of its length.  Ranks are counted within (length, salt) groups,
the salt being a hash of the piece's key, so that a length which a third of all pieces share is spread over all tasks.
The plan's runs, bounded by lengths x patterns, are all that goes to the executors.

Defined results: a null text is empty and is one piece of the end id; a null doc_id is packed like any other; rows that
repeat a doc_id are separate documents; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _store
from ._words import chunks
from ._workers import lean
from .tokenizer import encoder

CAPACITY = 4096


def _best_pair(have: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two available lengths a >= b with the largest sum of at most ``room``; have: counts by length."""
    lengths = np.flatnonzero(have[: room + 1])
    if not len(lengths):
        return None
    # For each a, the longest available b <= min(a, room - a); b = a needs two of them.
    at = np.searchsorted(lengths, np.minimum(lengths, room - lengths), side="right") - 1
    same = (at >= 0) & (lengths[np.maximum(at, 0)] == lengths) & (have[lengths] < 2)
    at = np.where(same, at - 1, at)
    ok = at >= 0
    if not ok.any():
        return None
    total = np.where(ok, lengths + lengths[np.maximum(at, 0)], -1)
    k = int(total.argmax())
    return int(lengths[k]), int(lengths[at[k]])


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (times, [(length, copies), ...]) that use every piece; counts[n]: the pieces of length n."""
    left = counts.astype(np.int64).copy()
    patterns = []
    while left.any():
        have, used, gap = left.copy(), {}, capacity
        while gap > 0:  # greedy: the longest piece that fits, as often as it fits
            fits = np.flatnonzero(have[1 : gap + 1])
            if not len(fits):
                break
            n = int(fits[-1]) + 1
            k = min(int(have[n]), gap // n)
            used[n] = used.get(n, 0) + k
            have[n] -= k
            gap -= k * n
        while gap > 0 and sum(used.values()) > 1:  # two for the smallest one
            small = min(used)
            have[small] += 1
            pair = _best_pair(have, gap + small)
            if pair is None or sum(pair) <= small:
                have[small] -= 1
                break
            used[small] -= 1
            used = {n: k for n, k in used.items() if k}
            for n in pair:
                used[n] = used.get(n, 0) + 1
                have[n] -= 1
            gap += small - sum(pair)
        times = min(int(left[n]) // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= times * k
        patterns.append((times, sorted(used.items(), reverse=True)))
    return patterns


def runs(patterns: list[tuple[int, list[tuple[int, int]]]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """For each (pattern, length): ranks from ``rank`` on go ``copies`` a sequence from ``first`` on, at ``offset``."""
    out, seen, first = [], np.zeros(capacity + 1, np.int64), 0
    for times, parts in patterns:
        offset = 0
        for n, k in parts:
            out.append((n, int(seen[n]), k, first, offset))
            seen[n] += times * k
            offset += n * k
        first += times
    out.sort()
    cols = np.array(out, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "copies", "first", "offset"), cols, strict=True))


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False, memo: int | None = None) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked, ids."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.binary())] if with_ids else []))

    @lean("tokenizer")
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail, step = encoder(tokenizer, memo), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in (c for batch in batches for c in chunks(batch, size=1 << 22)):
            doc_ids = b.column("doc_id").to_pylist()
            rows = []
            for doc_id, ids in zip(doc_ids, enc.encode(b.column("text")), strict=True):
                ids += tail
                for p, at in enumerate(range(0, len(ids), step)):
                    own = ids[at : at + step]
                    rows.append((doc_id, p, at // 4, len(own) // 4, zlib.crc32(own), own))
            cols = list(zip(*rows, strict=True))[: len(schema)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return _store.id_text(docs).mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ...); ``cut`` should be a written table."""
    spark = cut.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for n, k in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[n] = k
    where = spark.sparkContext.broadcast(runs(plan(counts, capacity), capacity))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("_own", own).join(sizes, ["length", "_salt"])
    ranked = ranked.select(*cut.columns, (F.col("_before") + F.col("_own") - 1).alias("_rank"))

    names = cut.columns

    @lean()
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = where.value
        lengths = np.searchsorted(run["length"], np.arange(capacity + 2))  # the first run of each length
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            at = np.empty(len(n), np.int64)
            order = np.argsort(n, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(n[order])) + 1) if len(n) else ():
                lo, hi = lengths[n[own[0]]], lengths[n[own[0]] + 1]
                at[own] = lo + np.searchsorted(run["rank"][lo:hi], rank[own], side="right") - 1
            q = rank - run["rank"][at]
            k = run["copies"][at]
            cols = [b.column(c) for c in names] + [pa.array(run["first"][at] + q // k), pa.array(run["offset"][at] + q % k * n)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False, memo: int | None = None) -> DataFrame:
    """Every piece of every document with its place.  Texts are encoded once; their pieces are a written table.

    Ids stay in that table while places are found, and join them at the end, so that no batch holds many of them.
    """
    cut = pieces(docs, tokenizer, capacity, end_id, with_ids, memo)
    if not with_ids:
        return pack(_store.materialize(cut, "pieces"), capacity)
    cut = _store.materialize(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    placed = pack(cut.drop("ids"), capacity).join(cut.select("_row", "ids"), "_row")
    return placed.select(*(c for c in cut.columns if c != "_row"), "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (of a pack made ``with_ids``), n_ids; a group is one sequence."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"), F.sum("length").alias("n_ids"))
    return held.select("sequence_id", F.aggregate("_p", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"), "n_ids")
