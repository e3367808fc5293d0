"""Lexical and dense ranking, and retrieval metrics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .dedup import cut

CUTOFFS = (5, 10, 20)
METRICS = ("recall@5", "recall@10", "recall@20", "mrr@10", "ndcg@10")


#: Query words (or vector components) that travel to the passages at once; more queries go in several turns.
SHIPPED = 4_000_000
#: Passages scored at a time.
CHUNK = 1024
#: Passages whose words are looked up at a time.
POSTED = 128


def _turns(queries: DataFrame, qid: str, size: int) -> Iterator[DataFrame]:
    """The queries in as many parts as their size asks for, dealt by a hash."""
    parts = max(1, -(-size // SHIPPED))
    for i in range(parts):
        yield queries if parts == 1 else queries.filter(F.pmod(F.xxhash64(qid), F.lit(parts)) == i)


def _best(scores: np.ndarray, pids: np.ndarray, least: float, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, passage) places of the ``top`` scores above ``least`` in each column, ties by pid."""
    queries, rows = [], []
    for q in range(scores.shape[1]):
        own = scores[:, q]
        at = np.flatnonzero(own > least)
        if len(at) > top:
            at = at[own[at] >= np.partition(own[at], -top)[-top]]
            at = at[np.lexsort((pids[at], -own[at]))[:top]]
        queries.append(np.full(len(at), q))
        rows.append(at)
    return np.concatenate(queries), np.concatenate(rows)


def _ranked(scored: DataFrame, qid: str, pid: str, top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "pid"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= top).select(F.col("qid").alias(qid), F.col("pid").alias(pid), "score", "rank")


def _postings(docs: DataFrame, words: list[str]) -> DataFrame:
    """pid, len, at, tf: of each passage its length and, for the asked words in it, their places in ``words`` and counts."""
    schema = pa.schema([("pid", pa.int64()), ("len", pa.int64()), ("at", pa.binary()), ("tf", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(words, pa.string())
        for batch in batches:
            for lo in range(0, batch.num_rows, POSTED):  # numbers of a few passages' words at a time
                b = batch.slice(lo, POSTED)
                lists = b.column("w")
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                at = pc.fill_null(pc.index_in(pc.list_flatten(lists), value_set=known), -1).to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                rows = [np.unique(x[x >= 0], return_counts=True) for x in np.split(at, ends[:-1])]
                yield pa.RecordBatch.from_arrays([b.column("pid"), pa.array(sizes, pa.int64()), pa.array([r[0].astype(np.int32).tobytes() for r in rows], pa.binary()), pa.array([r[1].astype(np.int32).tobytes() for r in rows], pa.binary())], schema=schema)

    return docs.mapInArrow(run, "pid long, len long, at binary, tf binary")


def _frequencies(postings: DataFrame) -> DataFrame:
    """at, df of every asked word: counted in each task, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for b in batches:
            at, n = np.unique(np.frombuffer(b"".join(b.column("at").to_pylist()), np.int32), return_counts=True)
            total.update(dict(zip(at.tolist(), n.tolist(), strict=True)))
        yield pa.RecordBatch.from_pydict({"at": pa.array(total.keys(), pa.int32()), "df": pa.array(total.values(), pa.int64())})

    return postings.select("at").mapInArrow(run, "at int, df long").groupBy("at").agg(F.sum("df").alias("df"))


def bm25(passages: DataFrame, queries: DataFrame, pid: str, qid: str, text: str = "text", top: int = 20, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """qid, pid, score (9 places), rank: the ``top`` passages of each query, ties by pid; query words count as often as they stand there.

    pid and qid are integers.  The queries' words travel to the passages, a bounded number of them at a time: each passage is reduced to its
    counts of the asked words, and scored against all queries by a matrix product where it lies.  A task sends on its ``top``
    passages a query and chunk, so no word, however common, is joined with anything.  Passages without a hit follow with score 0, by pid.
    """
    docs = passages.select(F.col(pid).cast("long").alias("pid"), T.normalized_tokens(F.col(text)).alias("w"))
    asked = cut(queries.select(F.col(qid).cast("long").alias("qid"), F.explode(T.normalized_tokens(F.col(text))).alias("word")).groupBy("qid", "word").agg(F.count(F.lit(1)).alias("times")))
    scored = None
    for turn in _turns(asked, "qid", asked.count()):
        rows = turn.collect()  # at most about SHIPPED
        words, ids = sorted({r.word for r in rows}), sorted({r.qid for r in rows})
        if not rows:
            continue
        postings = cut(_postings(docs, words))
        n, mean = postings.agg(F.count(F.lit(1)), F.greatest(F.coalesce(F.avg("len"), F.lit(1.0)), F.lit(1.0))).first()
        df = np.zeros(len(words))
        for r in _frequencies(postings).collect():  # one row an asked word
            df[r["at"]] = r["df"]
        place, column = {w: i for i, w in enumerate(words)}, {q: i for i, q in enumerate(ids)}
        cells = np.array([(place[r.word], column[r.qid], r.times) for r in rows])
        part = _scores(postings, np.log(1 + (n - df + 0.5) / (df + 0.5)), cells, np.array(ids), mean, top, k1, b)
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        scored = passages.sparkSession.createDataFrame([], "qid long, pid long, score double")
    ranked = _ranked(scored, "qid", "pid", top)
    # A query with fewer hits than ``top`` is filled up with the first passages that have none.
    short = queries.select(F.col(qid).cast("long").alias("qid")).join(ranked.groupBy("qid").agg(F.count(F.lit(1)).alias("k")), "qid", "left").filter(F.coalesce("k", F.lit(0)) < top).select("qid")
    spare = passages.select(F.col(pid).cast("long").alias("pid")).orderBy("pid").limit(2 * top)
    fill = short.crossJoin(F.broadcast(spare)).join(ranked.select("qid", "pid"), ["qid", "pid"], "left_anti").withColumn("score", F.lit(0.0))
    return _ranked(ranked.select("qid", "pid", "score").unionByName(fill.select("qid", "pid", "score")), qid, pid, top)


def _scores(postings: DataFrame, idf: np.ndarray, cells: np.ndarray, ids: np.ndarray, mean: float, top: int, k1: float, b: float) -> DataFrame:
    schema = pa.schema([("qid", pa.int64()), ("pid", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.zeros((len(idf), len(ids)))
        asked[cells[:, 0], cells[:, 1]] = cells[:, 2]
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                c = batch.slice(lo, CHUNK)
                at, tf = ([np.frombuffer(x, np.int32) for x in c.column(name).to_pylist()] for name in ("at", "tf"))
                rows, at, tf = np.repeat(np.arange(len(at)), [len(x) for x in at]), np.concatenate(at), np.concatenate(tf)
                norm = k1 * (1 - b + b * c.column("len").to_numpy() / mean)
                weight = np.zeros((c.num_rows, len(idf)))
                weight[rows, at] = idf[at] * tf * (k1 + 1) / np.maximum(tf + norm[rows], 1e-12)
                score, pids = np.round(weight @ asked, 9), c.column("pid").to_numpy(zero_copy_only=False)
                q, p = _best(score, pids, 0.0, top)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(pids[p]), pa.array(score[p, q])], schema=schema)

    return postings.mapInArrow(run, "qid long, pid long, score double")


def dense(vectors: DataFrame, queries: DataFrame, vid: str, qid: str, vector: str, top: int = 10) -> DataFrame:
    """qid, vid, score (9 places), rank: exact cosine top-k.  queries is a stated set; vid and qid are integers.

    The queries travel to the vectors, a bounded number of components at a time, and are multiplied with blocks of them; a task sends on its
    ``top`` vectors a query and block.  A zero vector is 0 from all; null vectors are left out; lengths must agree.
    """
    asked = cut(queries.filter(F.col(vector).isNotNull()).select(F.col(qid).cast("long").alias("qid"), F.col(vector).cast("array<double>").alias("v")))
    held = vectors.filter(F.col(vector).isNotNull()).select(F.col(vid).cast("long").alias("pid"), F.col(vector).cast("array<double>").alias("v"))
    schema = pa.schema([("qid", pa.int64()), ("pid", pa.int64()), ("score", pa.float64())])

    def unit(column: list) -> np.ndarray:
        x = np.array(column, np.float64).reshape(len(column), -1)
        return x / np.where((size := np.linalg.norm(x, axis=1)) == 0, 1, size)[:, None]

    scored = vectors.sparkSession.createDataFrame([], "qid long, pid long, score double")
    for turn in _turns(asked, "qid", asked.agg(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0]):
        rows = turn.collect()  # at most about SHIPPED components
        if not rows:
            continue
        ids, q = np.array([r.qid for r in rows]), unit([r.v for r in rows])

        def run(batches: Iterator[pa.RecordBatch], ids=ids, q=q) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, CHUNK):
                    c = batch.slice(lo, CHUNK)
                    pids = c.column("pid").to_numpy(zero_copy_only=False)
                    score = np.round(unit(c.column("v").to_pylist()) @ q.T, 9)
                    score[pids[:, None] == ids[None, :]] = -2
                    at, p = _best(score, pids, -1.5, top)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(pids[p]), pa.array(score[p, at])], schema=schema)

        scored = scored.unionByName(held.mapInArrow(run, "qid long, pid long, score double"))
    return _ranked(scored, qid, vid, top)


def _gain(rank: Column) -> Column:
    return 1 / F.log2(rank + 1)


def retrieval_metrics(ranking: DataFrame, relevant: DataFrame, qid: str, pid: str) -> DataFrame:
    """qid and the five metrics of every query that has relevant passages; an absent ranking scores 0."""
    need = relevant.groupBy(qid).agg(F.count(F.lit(1)).alias("need"))
    hits = ranking.join(relevant.select(qid, pid), [qid, pid]).groupBy(qid).agg(
        *(F.count_if(F.col("rank") <= c).alias(f"h{c}") for c in CUTOFFS),
        F.min(F.when(F.col("rank") <= 10, F.col("rank"))).alias("first"),
        F.sum(F.when(F.col("rank") <= 10, _gain(F.col("rank")))).alias("dcg"),
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.lit(10), F.col("need")).cast("int")), F.lit(0.0), lambda s, r: s + _gain(r))
    zero = F.lit(0.0)
    out = need.join(hits, qid, "left")
    return out.select(qid, *(F.coalesce(F.col(f"h{c}") / F.col("need"), zero).alias(f"recall@{c}") for c in CUTOFFS), F.coalesce(1 / F.col("first"), zero).alias("mrr@10"), F.coalesce(F.col("dcg") / ideal, zero).alias("ndcg@10"))


def breakdown(per_item: DataFrame, dimensions: list[str], metrics: list[str]) -> DataFrame:
    """dimension, key, items and the mean of each metric (6 places), with the whole under ``overall``."""
    keys = [F.struct(F.lit("overall").alias("dimension"), F.lit("all").alias("key")), *(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("key")) for d in dimensions)]
    rows = per_item.select(F.explode(F.array(*keys)).alias("d"), *metrics)
    means = [F.round(F.avg(F.col(f"`{m}`")), 6).alias(m) for m in metrics]
    return rows.groupBy("d.dimension", "d.key").agg(F.count(F.lit(1)).alias("items"), *means)


def contamination(docs: DataFrame, items: DataFrame, did: str, iid: str, width: int = 8) -> DataFrame:
    """did, iid, shared: documents and benchmark items that share ``width``-word runs, and how many distinct ones.

    Runs travel as two 64-bit hashes, never as text.
    """

    def runs(rows: DataFrame, key: str) -> DataFrame:
        held = T.let(T.normalized_tokens(F.col("text")), lambda w: F.transform(T.shingles(w, width), lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(x, F.lit(1)).alias("g"))))
        return rows.select(key, F.inline(held))

    return runs(docs, did).join(runs(items, iid), ["h", "g"]).groupBy(did, iid).agg(F.count(F.lit(1)).alias("shared"))


def contains(docs: DataFrame, items: DataFrame, did: str, iid: str, text: str = "text", width: int = 4) -> DataFrame:
    """did, iid of documents whose text holds an item's whole text; both keys are unique.

    An item is looked up by the hash of one run of ``width`` whole words of its own: only hashes travel, and texts are fetched for the
    pairs that share one, which are then compared in full.  Items of fewer words are searched for together, in one automaton.
    """
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    inner = F.slice(words, 2, width)  # the first and last word may be cut off from a longer one
    keyed = items.filter(F.length(text) > 0).select(iid, F.col(text).alias("_item"), F.when(F.size(words) >= width + 2, F.xxhash64(F.array_join(inner, " "))).alias("h"))

    def hashes(w: Column) -> Column:
        places = F.when(F.size(w) >= width, F.sequence(F.lit(1), F.size(w) - (width - 1)))
        return F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(w, i, width), " "))))

    pairs = docs.select(did, F.explode(T.let(words, hashes)).alias("h")).join(keyed.filter("h is not null").select(iid, "h"), "h").select(did, iid)
    full = pairs.join(docs.select(did, text), did).join(keyed.select(iid, "_item"), iid)
    hits = full.filter(F.contains(F.col(text), F.col("_item"))).select(did, iid)
    short = cut(keyed.filter("h is null").select(F.col(iid).cast("string").alias("key"), "_item"))
    if not short.limit(1).count():
        return hits
    kinds = dict(docs.dtypes)[did], dict(items.dtypes)[iid]
    for turn in _turns(short, "key", short.agg(F.sum(F.length("_item"))).first()[0]):
        found = _searched(docs.select(F.col(did).cast("string").alias("did"), F.col(text).alias("text")), [tuple(r) for r in turn.collect()])  # at most about SHIPPED characters
        hits = hits.unionByName(found.select(F.col("did").cast(kinds[0]).alias(did), F.col("key").cast(kinds[1]).alias(iid)))
    return hits


def _searched(docs: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
    """did, key of the items that occur in each text."""
    schema = pa.schema([("did", pa.string()), ("key", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        keys: dict[str, list[str]] = {}
        for key, item in items:
            keys.setdefault(item, []).append(key)
        automaton = ahocorasick.Automaton()
        for item in keys:
            automaton.add_word(item, item)
        automaton.make_automaton()
        for b in batches:
            out = [(did, key) for did, t in zip(b.column("did").to_pylist(), b.column("text").to_pylist(), strict=True) if t for item in {x for _, x in automaton.iter(t)} for key in keys[item]]
            dids, found = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(dids, pa.string()), pa.array(found, pa.string())], schema=schema)

    return docs.mapInArrow(run, "did string, key string")
