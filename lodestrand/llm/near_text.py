"""Near-duplicate texts by Order MinHash and banded alignment.

A text's k-mers are its runs of five words, each labelled by its occurrence: the second time that a run stands in a text is
a k-mer of its own.  A band of the sketch samples the few k-mers with the least hash under the band's own permutation and keeps them
in the order of the text, so that texts share a band as far as they agree in what they hold, how often and in which order: in edit
similarity.  Texts that agree in a band are candidates.

A candidate pair is decided by a banded alignment of the two k-mer sequences.  Labelled k-mers are unique, so the alignment
is a longest increasing run of matching places inside the band that the similarity allows; M matches give M / (n + m - M).
Texts that hold the same k-mers in another order are as similar as what stays in order.

Equal texts are one node from the start, and a text is one row, with the list of its buckets.  Comparisons come in rounds, each on
what the rounds before left apart, and a bucket whose texts are all in one component is done:

* Every text is compared with one text of each of its buckets, the hub.  That links groups of copies, of any size.
* A small bucket (``SMALL``) that still holds two components is compared in full, save for pairs of one component.
* In a large one most pairs are ruled out unseen, and exactly.  Only k-mers that occur in two or more texts of such buckets can
  match; a text whose matchable k-mers are too few for any partner of the bucket leaves it; once more, counted among those
  that stay.  The others are compared with the bucket's pivot, the text whose k-mers are the commonest, on average: the least
  edited one, to which most others are linked.
* Those outside the pivot's component are compared, for each of their k-mers, with the text of the commonest k-mers that holds it:
  copies of an edited copy meet that one.
* Those still outside are compared with all of the bucket that may reach the limit, in salted blocks.  What two members can have
  in common, inside the pivot and outside of it, is at most the smaller count of the two in either part.

Defined results: a null text is empty; texts of under five words have one k-mer, all their words; texts without words are
all alike; texts of any length are sketched and compared whole; rows that repeat a doc_id are separate documents; a null doc_id is the
least where one row is kept, but names a class only if all of the class are null; an empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small as few_rows
from . import _graph, _store
from ._words import FIRST, Words, chunks, grams, mix
from ._workers import lean

K, BANDS, ROWS, SIMILARITY = 5, 14, 3, 0.8
#: Buckets of up to this many texts are compared in full.
SMALL = 8
#: Members of a bucket that meet its outsiders in one task.
SALTED = 1024
#: Links of different texts up to which the driver joins components, and rows of texts, pairs and components that are broadcast (32 bytes a row and more).
FEW = 100_000
#: Pairs for which comparing has a further task; a task of Python costs as much as some hundred of them.
PAIRS_A_TASK = 512


def text_key(text: str = "text") -> Column:
    """128 bits that stand for the whole text."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), 1, 32))


def _labelled_runs(own: np.ndarray) -> np.ndarray:
    """The k-mers' hashes, from the second occurrence of one on mixed with its number."""
    order = np.argsort(own, kind="stable")
    again = np.flatnonzero(np.diff(own[order]) == 0) + 1
    if not len(again):
        return own
    # The number of an occurrence: how far it stands from its run's first in the sorted order.
    first = np.ones(len(own), bool)
    first[again] = False
    number = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
    out = own.copy()
    later = order[again]
    out[later] = mix(own[later] ^ mix(number[again].astype(np.uint64)))
    return out


def kmers(words: Words, k: int = K) -> list[np.ndarray]:
    """For each text the hashes of its k-mers in order, labelled by occurrence."""
    hashes = words.hashes()
    all_grams, out = grams(hashes, k), []
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        own = all_grams[a : b - k + 1] if b - a >= k else FIRST.ranges(hashes[a:b], np.array([0]), np.array([b - a]))
        out.append(_labelled_runs(own))
    return out


def sketch(own: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Per band a hash of the ``rows`` least k-mers under the band's permutation, in the order of the text."""
    out = np.empty(bands, np.uint64)
    for b in range(bands):
        h = mix(own ^ np.uint64((b + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
        least = h[np.sort(np.argpartition(h, rows)[:rows])] if len(h) > rows else h
        acc = b + 1
        for x in least.tolist():
            acc = (acc * 0x100000001B3 ^ x) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        out[b] = acc ^ acc >> 29
    return out


def _increasing(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    if len(places) < 2 or (np.diff(places) > 0).all():
        return len(places)
    tails: list[int] = []
    for p in places.tolist():
        i = bisect_left(tails, p)
        tails[i : i + 1] = [p]
    return len(tails)


def compared(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> tuple[int, bool]:
    """(common k-mers, whether the two sequences reach the similarity by banded alignment)."""
    n, m = len(a), len(b)
    need = _needed(n, m, similarity)
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = len(at_a)
    if common < need:  # an alignment has no more matches than that
        return common, False
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    # Indels beyond the band would cost more than the limit allows.
    near = np.abs(at_a - at_b) <= n + m - 2 * need
    return common, _increasing(at_b[near]) >= need


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    return compared(a, b, similarity)[1]


def sketches(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key, bands of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                made = [pa.array(sketch(own, bands, rows).view(np.int64)) for own in kmers(Words(c.column("text")), k)]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * bands), pa.concat_arrays(made))
                yield pa.RecordBatch.from_arrays([c.column("doc_id"), c.column("key"), flat], schema=schema)

    return _store.id_text(docs).withColumn("key", text_key()).mapInArrow(run, "doc_id long, key binary, bands array<long>")


def _shingled(docs: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """key, kmers (64-bit integers) of one document of each key."""
    schema = pa.schema([("key", pa.binary()), ("kmers", pa.binary())])

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                own = [x.tobytes() for x in kmers(Words(c.column("text")), k)]
                yield pa.RecordBatch.from_arrays([c.column("key"), pa.array(own, pa.binary())], schema=schema)

    # Only the document that stands for its key is asked for, so each text travels once, or not at all if few are asked for.
    asked = few_rows(keys.select(F.col("doc_id").alias("asked_id"), "key"), FEW)
    own = _store.id_text(docs).withColumn("own_key", text_key())
    rows = own.join(asked, F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("own_key") == F.col("key"))).select("key", "text")
    return rows.mapInArrow(run, "key binary, kmers binary").dropDuplicates(["key"])


def _verified(pairs: DataFrame, kmer_table: DataFrame, similarity: float) -> DataFrame:
    """a, b, common, linked for every pair."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("common", pa.int64()), ("linked", pa.bool_())])

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in batches:
            got = [compared(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity) for x, y in zip(c.column("ka").to_pylist(), c.column("kb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.column("a"), c.column("b"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.bool_())], schema=schema)

    pairs = _store.materialize(pairs, "pairs")
    n = pairs.count()
    tasks = 2 * pairs.sparkSession.sparkContext.defaultParallelism + n // PAIRS_A_TASK
    left = (F.broadcast(pairs) if n <= FEW else pairs).join(kmer_table.select(F.col("key").alias("a"), F.col("kmers").alias("ka")), "a")
    both = left.join(kmer_table.select(F.col("key").alias("b"), F.col("kmers").alias("kb")), "b")
    return both.select("a", "b", "ka", "kb").coalesce(tasks).mapInArrow(run, "a binary, b binary, common long, linked boolean")


def _needed(n, m, similarity: float):
    """Common k-mers that texts of n and m k-mers need."""
    return (n + m) * (similarity / (1 + similarity)) - 1e-6


def _exploded(kmer_table: DataFrame, keys: DataFrame) -> DataFrame:
    """key, n, h: one row a k-mer of the texts of ``keys``."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("h", pa.int64())])
        for batch in batches:
            for c in chunks(batch, "kmers", 1 << 20):
                raw = c.column("kmers").to_pylist()
                n = np.array([len(r) // 8 for r in raw])
                at = np.repeat(np.arange(len(raw)), n)
                yield pa.RecordBatch.from_arrays([c.column("key").take(pa.array(at)), pa.array(n[at]), pa.array(np.frombuffer(b"".join(raw), np.int64))], schema=schema)

    return kmer_table.join(few_rows(keys, FEW), "key", "left_semi").mapInArrow(run, "key binary, n long, h long")


def _peeled(texts: DataFrame, kmer_table: DataFrame, similarity: float) -> DataFrame:
    """key, n, c, w, buckets: the texts that may have a partner, with the buckets where; c: matchable k-mers, w: how often they occur."""
    each = _store.materialize(_exploded(kmer_table, texts.select("key")), "kmer-rows")
    held, alive = texts.select("key", "buckets"), each
    for again in (True, False):
        common = alive.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
        c = alive.join(common, "h", "left").groupBy("key").agg(F.first("n").alias("n"), F.count("df").alias("c"), F.coalesce(F.sum("df"), F.lit(0)).alias("w"))
        rows = held.join(c, "key").select("key", "n", "c", "w", F.explode("buckets").alias("bucket"))
        # The shortest text of the bucket is the best partner for what a text has; a shorter one than the limit is none.
        least = rows.groupBy("bucket").agg(F.min("n").alias("low"))
        able = F.col("c") >= _needed(F.col("n"), F.greatest(F.col("low").cast("double"), F.col("n") * similarity), similarity)
        after = rows.join(least, "bucket").filter(able).groupBy("key", "n", "c", "w").agg(F.collect_list("bucket").alias("buckets"))  # at most one a band
        after = _store.materialize(after, "peeled")
        held = after.select("key", "buckets")
        if again:
            alive = each.join(few_rows(held.select("key"), FEW), "key", "left_semi")
    _store.discard(each)
    return after


def _rank() -> Column:
    """The texts of the commonest k-mers, which are the least edited, are the greatest."""
    return F.struct((F.col("w") / F.col("n")).alias("share"), "n", "key")


def _pivoted(members: DataFrame, kmer_table: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(bucket, key, n, c, buckets, pivot, m: k-mers in common with the bucket's pivot; the comparisons made)."""
    rows = members.select("key", "n", "c", "w", "buckets", F.explode("buckets").alias("bucket"))
    heads = _store.materialize(rows.groupBy("bucket").agg(F.max(_rank()).alias("best")).select("bucket", F.col("best.key").alias("pivot")), "pivots")
    held = rows.join(heads, "bucket")
    pairs = held.select(F.col("key").alias("a"), F.col("pivot").alias("b")).filter("a <> b").distinct()
    checked = _store.materialize(_verified(pairs, kmer_table, similarity), "verified")
    known = checked.groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("b", "common"))).alias("common"))  # at most one a bucket of the text
    common = F.when(F.col("a") == F.col("pivot"), F.col("n")).otherwise(F.col("common")[F.col("pivot")])
    out = held.withColumnRenamed("key", "a").join(known, "a", "left").select("bucket", F.col("a").alias("key"), "n", "c", "buckets", "pivot", common.alias("m"))
    return _store.materialize(out, "pivoted"), checked


def _by_kmers(members: DataFrame, outside: DataFrame, kmer_table: DataFrame) -> DataFrame:
    """Pairs a, b: each text outside with the least edited member that holds it, for every one of its k-mers."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rank", batch_rank), ("h", pa.int64())])
        for batch in batches:
            for c in chunks(batch, "kmers", 1 << 20):
                raw = c.column("kmers").to_pylist()
                at = np.repeat(np.arange(len(raw)), [len(r) // 8 for r in raw])
                yield pa.RecordBatch.from_arrays([c.column("rank").take(pa.array(at)), pa.array(np.frombuffer(b"".join(raw), np.int64))], schema=schema)

    batch_rank = pa.struct([("share", pa.float64()), ("n", pa.int64()), ("key", pa.binary())])
    kind = "rank struct<share: double, n: bigint, key: binary>, h long"
    ranked = few_rows(members.select("key", _rank().alias("rank")), FEW)
    own = ranked.join(kmer_table, "key").select("rank", "kmers").mapInArrow(run, kind)
    hubs = own.groupBy("h").agg(F.max("rank").alias("hub"), F.count(F.lit(1)).alias("df")).filter("df > 1").select("h", F.col("hub.key").alias("b"))
    asked = ranked.join(outside.select("key").distinct(), "key", "left_semi").join(kmer_table, "key").select("rank", "kmers").mapInArrow(run, kind)
    return asked.select(F.col("rank.key").alias("a"), "h").join(hubs, "h").filter("a <> b").select("a", "b").distinct()


def _linked(links: DataFrame) -> DataFrame:
    """node, component of every linked key; broadcast if they are few."""
    return few_rows(_store.materialize(_graph.components(links, few=FEW), "labels"), FEW)


def _labelled(rows: DataFrame, label: DataFrame, key: str = "key", name: str = "component") -> DataFrame:
    """The rows with their key's component; a key without a link is one of its own."""
    own = label.select(F.col("node").alias(key), F.col("component").alias(name))
    return rows.join(own, key, "left").withColumn(name, F.coalesce(name, key))


def _undone(texts: DataFrame, label: DataFrame) -> DataFrame:
    """key, buckets (bucket, size) of the texts of buckets that hold two components."""
    rows = _labelled(texts, label).select("key", "component", F.inline("buckets"))
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    rows = rows.join(mixed.select("bucket"), "bucket", "left_semi")
    return rows.groupBy("key", "component").agg(F.collect_list(F.struct("bucket", "size")).alias("buckets"))  # at most one a band


def _outside(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of ``_pivoted`` whose text is not in its pivot's component."""
    return _labelled(_labelled(rows, label), label, "pivot", "home").filter("component <> home")


def _residual(rows: DataFrame, label: DataFrame, similarity: float) -> DataFrame:
    """Pairs a, b of a bucket that the rounds before left apart and that may reach the limit; rows: see ``_pivoted``."""
    state = _labelled(_labelled(rows, label), label, "pivot", "home")
    outside = F.count_if(F.col("component") != F.col("home"))
    # Salted blocks of at most SALTED of the bucket's texts.
    size = state.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), outside.alias("outside")).filter("outside > 0")
    state = state.join(size.select("bucket", F.ceil(F.col("size") / SALTED).cast("int").alias("salts")), "bucket")
    out = state.filter("component <> home").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    other = state.withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")).cast("int"))
    other = other.select("bucket", "salt", *(F.col(x).alias(f"o_{x}") for x in ("key", "component", "n", "c", "m", "buckets")))
    # Common k-mers lie in the pivot or outside of it; either part is at most the smaller of the two texts'.
    able = F.least("m", "o_m") + F.least(F.col("c") - F.col("m"), F.col("o_c") - F.col("o_m")) >= _needed(F.col("n"), F.col("o_n"), similarity)
    once = F.array_min(F.array_intersect("buckets", "o_buckets")) == out["bucket"]
    # Two outsiders meet twice; the lesser key's row makes the pair.
    ordered = (F.col("o_component") == F.col("home")) | (F.col("key") < F.col("o_key"))
    met = (out["bucket"] == other["bucket"]) & (out["salt"] == other["salt"]) & (F.col("component") != F.col("o_component")) & able & ordered & once
    return out.join(other, met).select(F.least("key", "o_key").alias("a"), F.greatest("key", "o_key").alias("b")).distinct()


def classes(docs: DataFrame, k: int = K, bands: int = BANDS, rows: int = ROWS, similarity: float = SIMILARITY, small: int = SMALL) -> DataFrame:
    """doc_id, key, class_id (the least doc_id of the class), kept (one row of each class)."""
    made = _store.materialize(sketches(docs, k, bands, rows), "sketches")
    nodes = made.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    each = nodes.select("key", "doc_id", F.posexplode("bands").alias("band", "sig")).select("key", "doc_id", F.xxhash64("band", "sig").alias("bucket"))
    hubs = each.groupBy("bucket").agg(F.min("key").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    held = each.join(hubs, "bucket").groupBy("key", "doc_id").agg(F.collect_list(F.struct("bucket", "size")).alias("buckets"), F.collect_set("hub").alias("hubs"))  # at most one a band
    texts = _store.materialize(held, "buckets")
    table = _store.materialize(_shingled(docs, texts.select("key", "doc_id"), k), "kmers")

    pairs = texts.select(F.col("key").alias("a"), F.explode("hubs").alias("b")).filter("a <> b")
    seen = _store.materialize(_verified(pairs, table, similarity), "verified")
    label = _linked(seen.filter("linked"))

    rest = _store.materialize(_undone(texts, label), "undone")
    if rest.limit(1).count():
        some = rest.select("key", "component", F.inline("buckets"))
        few = some.filter(F.col("size") <= small)
        left, right = few.select("bucket", F.col("key").alias("a"), "component"), few.select("bucket", F.col("key").alias("b"), F.col("component").alias("other"))
        pairs = left.join(right, "bucket").filter("a < b and component <> other").select("a", "b").distinct()
        seen = seen.unionByName(_store.materialize(_verified(pairs, table, similarity), "verified"))
        large = rest.select("key", F.transform(F.filter("buckets", lambda x: x["size"] > small), lambda x: x["bucket"]).alias("buckets"))
        peeled = _peeled(large.filter(F.size("buckets") > 0), table, similarity)
        many, pivoted = _pivoted(peeled, table, similarity)
        seen = seen.unionByName(pivoted)
        label = _linked(seen.filter("linked"))
        for pairs in (lambda: _by_kmers(peeled, _outside(many, label), table), lambda: _residual(many, label, similarity)):
            checked = _store.materialize(_verified(pairs(), table, similarity), "verified")
            seen = seen.unionByName(checked)
            if checked.filter("linked").limit(1).count():
                label = _linked(seen.filter("linked"))
    _store.discard(texts, table, rest)
    rows_ = _labelled(made.select("doc_id", "key"), label)
    least = rows_.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.min(F.struct("doc_id", "key")).alias("_first"))
    out = rows_.join(least, "component")
    return out.select("doc_id", "key", "class_id", F.struct("doc_id", "key").eqNullSafe(F.col("_first")).alias("kept"))
