"""Duplicate passages by relative Lempel-Ziv parsing.

Every text is parsed against the whole corpus as reference.  The corpus is cut into reference blocks: the stretches of
words whose 20-word windows share one anchor, the least-hashed k-gram of the window (leftmost of ties).  Equal windows
choose equal anchors, so a block's factors can only begin in blocks that are filed under the same anchor.

A block that equals an earlier one is matched whole and needs no look at its words: it has a source, the place of the earlier
block.  Where a text's block meets its anchor in the index but differs from the blocks filed there, a factor begins or ends inside it:
these boundary blocks, and only they, are read again and looked up window by window, which gives each window its source.

Then every text is parsed from left to right.  Matched stretches that go on in the same source are joined; from the leftmost matched
word not yet in a factor, the source that reaches furthest is taken, greedily, and its words are one factor: start, length,
and the source's document and start.  Words outside are literals.  A factor has at least a window's words and lies, as it stands, at an earlier
place; as windows over the boundary of two factors are matched too, a factor may begin inside the one before.  The factors
are the duplicate spans.  The outcome is exact: a word is removed if and only if a window that covers it starts earlier too.

Inside a task equal blocks (and windows) are settled before the shuffle: only the first goes on, so a passage held by
a third of all texts sends one row a task, not one a copy.  An anchor under which a task has met two different blocks is mixed: from
then on the task sends its blocks to the window look-up without filing them, so a phrase of a third of all texts sends a few rows a
task, not one a text.

"Earlier" is a smaller doc_id, or an earlier start in the same document, on the texts as they came.

Defined results: a null text has no words; rows that repeat doc_id and text are one document, and treated alike; rows that repeat a doc_id
with another text are ordered by a hash of the text; a null doc_id is before all others; texts of under ``window`` words are kept whole;
a text of any length is parsed whole, and is a run of its own in memory; an empty table gives no row; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _store
from ._words import FIRST, SECOND, Words, chunks, grams, mix
from ._workers import lean

WINDOW, GRAM = 20, 6
#: at: the block's own place; source: an earlier block equal to it in the task, if there is one; mixed: to be looked up window by window.
PLACE = "struct<doc_id: bigint, tie: bigint, lo: int>"
BLOCK = f"anchor long, h1 long, h2 long, at {PLACE}, hi int, source {PLACE}, mixed boolean"
_PLACE = pa.struct([("doc_id", pa.int64()), ("tie", pa.int64()), ("lo", pa.int32())])
_BLOCK = pa.schema([("anchor", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("at", _PLACE), ("hi", pa.int32()), ("source", _PLACE), ("mixed", pa.bool_())])
#: A matched stretch of a text and its source: window starts lo..hi there, the first of them at src_lo.
SPANS = ("lo", "hi", "src_doc", "src_tie", "src_lo")


def _tie(text: str = "text") -> Column:
    return F.xxhash64(text)


def _ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A key column as integers; null doc_ids sort first."""
    import pyarrow.compute as pc

    return pc.fill_null(batch.column(name), -(1 << 63)).to_numpy(zero_copy_only=False)


def _rows(anchor, h1, h2, doc, tie, text_of, lo, hi, nulls, known: np.ndarray | None = None) -> tuple[pa.RecordBatch, np.ndarray]:
    """Blocks (or windows), all but the first of equal ones with their source; then the anchors found to be mixed, those ``known`` included.

    A row that has its source, or whose anchor was known to be mixed, gets an anchor of its own, so that it rides along and
    meets nobody.  Of an anchor found to be mixed the first blocks are filed, so that other tasks see it.
    """
    order = np.lexsort((lo, tie[text_of], doc[text_of], h2, h1))
    first = np.arange(len(order))
    copy = np.zeros(len(order), bool)
    if len(order) > 1:
        p, q = order[:-1], order[1:]
        equal = (h1[p] == h1[q]) & (h2[p] == h2[q])
        # Rows that repeat doc_id and text are one document: the same place is no earlier place.
        place = (doc[text_of[p]] == doc[text_of[q]]) & (tie[text_of[p]] == tie[text_of[q]]) & (lo[p] == lo[q])
        run = np.r_[True, ~equal]
        first_of_run = np.maximum.accumulate(np.where(run, np.arange(len(order)), 0))
        step = np.cumsum(np.r_[True, ~(equal & place)])
        copy[order] = step > step[first_of_run]
        first[order] = order[first_of_run]
    mixed = np.zeros(len(order), bool)
    if known is not None:
        mixed = ~copy & np.isin(anchor, known)
        filed = np.flatnonzero(~copy & ~mixed)
        by = filed[np.lexsort((h2[filed], h1[filed], anchor[filed]))]
        if len(by) > 1:
            same = anchor[by[1:]] == anchor[by[:-1]]
            other = same & ((h1[by[1:]] != h1[by[:-1]]) | (h2[by[1:]] != h2[by[:-1]]))
            fresh = np.unique(anchor[by[1:]][other])
            # How many different blocks of its anchor come before each: two are filed, the others looked up.
            ahead = np.cumsum(np.r_[0, other])
            start = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(by)), 0))
            mixed[by[ahead - ahead[start] > 1]] = True
            known = np.union1d(known, fresh)
    own = mix((doc[text_of].view(np.uint64) * np.uint64(31) + lo.astype(np.uint64)) ^ tie[text_of].view(np.uint64))
    anchor = np.where(copy | mixed, own, anchor)

    def places(at: np.ndarray, there: np.ndarray | None = None) -> pa.StructArray:
        t = text_of[at]
        d = pa.array(doc[t], mask=nulls[t] if nulls.any() else None)
        return pa.StructArray.from_arrays([d, pa.array(tie[t]), pa.array(lo[at].astype(np.int32))], fields=list(_PLACE), mask=None if there is None else pa.array(~there))

    cols = [pa.array(anchor.view(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), places(np.arange(len(order))), pa.array(hi.astype(np.int32)), places(first, copy), pa.array(mixed)]
    return pa.RecordBatch.from_arrays(cols, schema=_BLOCK), known


def blocks_of(words: Words, window: int = WINDOW, k: int = GRAM):
    """(anchor, first hash, second hash, text, lo, hi) of every block; lo..hi are window starts, as words of the text."""
    one, two, last = words.hashes(FIRST), words.hashes(SECOND), words.last()
    n, span = len(words), window - k + 1
    if n < window:
        return None
    g = grams(one, k)
    at = np.arange(n - window + 1)
    anchor = at + np.lib.stride_tricks.sliding_window_view(g, span)[: len(at)].argmin(axis=1)
    inside = at + window <= last[at]
    starts = at[inside]
    if not len(starts):
        return None
    own = anchor[inside]
    cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(starts) != 1))
    lo, hi = starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]]
    pos = own[np.r_[0, cut + 1]]
    # The place of the anchor belongs to the block: equal hashes stand for equal windows in equal order.
    place = (pos - lo).astype(np.uint64) + np.uint64(1)
    h1 = mix(FIRST.ranges(one, lo, hi + window) + place)
    h2 = mix(SECOND.ranges(two, lo, hi + window) + place)
    text_of = np.searchsorted(words.bounds, lo, side="right") - 1
    return g[pos], h1, h2, text_of, lo - words.bounds[text_of], hi - words.bounds[text_of]


def _index(docs: DataFrame, window: int, k: int) -> DataFrame:
    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixed = np.empty(0, np.uint64)
        for batch in batches:
            for c in chunks(batch, size=1 << 22):
                found = blocks_of(Words(c.column("text")), window, k)
                if found:
                    anchor, h1, h2, text_of, lo, hi = found
                    rows, mixed = _rows(anchor, h1, h2, _ids(c, "doc_id"), _ids(c, "tie"), text_of, lo, hi, c.column("doc_id").is_null().to_numpy(zero_copy_only=False), mixed)
                    yield rows

    return docs.mapInArrow(run, BLOCK)


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """The windows lo..hi (an array of pairs) of every text, one row each."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch, size=1 << 22):
                words = Words(c.column("text"))
                one, two = words.hashes(FIRST), words.hashes(SECOND)
                g1, g2 = grams(one, window, FIRST), grams(two, window, SECOND)
                text_of, lo = [], []
                for t, blocks in enumerate(c.column("blocks").to_pylist()):
                    for b in blocks:
                        lo.append(np.arange(b["lo"], b["hi"] + 1))
                        text_of.append(np.full(len(lo[-1]), t))
                if not lo:
                    continue
                text_of, lo = np.concatenate(text_of), np.concatenate(lo)
                at = words.bounds[text_of] + lo
                yield _rows(g1[at], g1[at], g2[at], _ids(c, "doc_id"), _ids(c, "tie"), text_of, lo, lo, c.column("doc_id").is_null().to_numpy(zero_copy_only=False))[0]

    return docs.mapInArrow(run, BLOCK)


def _strip(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, tie, n_words, n_removed, kept: the words left, joined by one space."""
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in (x for batch in batches for x in chunks(batch, size=1 << 22)):
            kept, n_words, n_removed = [], [], []
            for text, spans in zip(c.column("text").to_pylist(), c.column("spans").to_pylist(), strict=True):
                words = text.encode().split()
                n = len(words)
                if spans:
                    words = _left(words, spans, window)
                kept.append(b" ".join(words))
                n_words.append(n)
                n_removed.append(n - len(words))
            digests = [hashlib.sha256(x).hexdigest() for x in kept]
            yield pa.RecordBatch.from_arrays([c.column("doc_id"), c.column("tie"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())], schema=schema)

    return docs.mapInArrow(run, "doc_id long, tie long, n_words long, n_removed long, kept string, kept_sha256 string")


def matches(docs: DataFrame, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """doc_id, tie, spans: each text's matched stretches with their sources (``SPANS``).  docs: doc_id, text, tie."""

    def sourced(rows: DataFrame) -> DataFrame:
        # The first of equal blocks is the others' source.  Rows that repeat doc_id and text have one place, which is no earlier one.
        first = F.first("at").over(Window.partitionBy("anchor", "h1", "h2").orderBy("at"))
        return rows.withColumn("source", F.coalesce("source", F.when(F.col("at") != first, first)))

    group = Window.partitionBy("anchor")
    filed = sourced(_index(docs, window, k))
    differ = (F.min("h1").over(group) != F.max("h1").over(group)) | (F.min("h2").over(group) != F.max("h2").over(group))
    filed = filed.withColumn("mixed", F.col("mixed") | differ)
    told = _store.materialize(filed.filter("source is not null or mixed").select("at.*", "hi", "source"), "blocks")
    open_ = told.filter("source is null").groupBy("doc_id", "tie").agg(F.collect_set(F.struct("lo", "hi")).alias("blocks"))  # at most a text's own words
    again = docs.join(_renamed(open_), _same_document()).select("doc_id", "tie", "text", "blocks")
    late = sourced(_windows(again, window)).filter("source is not null").select("at.*", "hi", "source")
    found = told.filter("source is not null").unionByName(late)
    span = F.struct("lo", "hi", F.col("source.doc_id").alias("src_doc"), F.col("source.tie").alias("src_tie"), F.col("source.lo").alias("src_lo"))
    return found.groupBy("doc_id", "tie").agg(F.collect_set(span).alias("spans"))  # at most a text's own words


def parse(spans: list[dict], window: int = WINDOW) -> list[tuple[int, int, int | None, int, int]]:
    """A text's factors (start, words, source's doc_id, tie and start) by its matched stretches, in order of their starts."""
    rows = sorted((s["src_doc"] is not None, s["src_doc"] or 0, s["src_tie"], s["src_lo"] - s["lo"], s["lo"], s["hi"]) for s in spans)
    runs: list[list] = []
    for *source, lo, hi in rows:
        if runs and runs[-1][2] == source and lo <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi, source])
    runs.sort(key=lambda r: (r[0], -r[1]))
    out, at, i, best = [], -1, 0, None  # at: the last window start that a factor holds
    while True:
        while i < len(runs) and runs[i][0] <= at + 1:
            if best is None or runs[i][1] > best[1]:
                best = runs[i]
            i += 1
        if best is None or best[1] <= at:
            if i == len(runs):
                return out
            at, best = runs[i][0] - 1, None  # literals in between
            continue
        lo, hi, (known, doc, tie, shift) = at + 1, best[1], best[2]
        out.append((lo, hi - lo + window, doc if known else None, tie, lo + shift))
        at = hi


def factors(docs: DataFrame, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """doc_id, tie, start, length, source_id, source_tie, source_start: the factors of every text, in words."""
    names = ("start", "length", "source_id", "source_tie", "source_start")
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), *zip(names, kinds, strict=True)])

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in batches:
            made = [parse(s, window) for s in c.column("spans").to_pylist()]
            at = pa.array([i for i, m in enumerate(made) for _ in m], pa.int64())
            cols = list(zip(*(f for m in made for f in m), strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([c.column("doc_id").take(at), c.column("tie").take(at), *(pa.array(x, t) for x, t in zip(cols, kinds, strict=True))], schema=schema)

    rows = _store.id_text(docs).withColumn("tie", _tie())
    return matches(rows, window, k).mapInArrow(run, "doc_id long, tie long, start int, length int, source_id long, source_tie long, source_start int")


def _renamed(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({"doc_id": "_doc_id", "tie": "_tie"})


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("tie") == F.col("_tie"))


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """All columns of docs (doc_id, text and any others): texts without their repeated words, the words left joined by one
    space; texts that repeat nothing are untouched.  A document of which no word is left is dropped.  n_chars, if there, follows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", _tie())
    spans = matches(rows.select("doc_id", "text", "tie"), window, k)
    (name,) = _store.fresh(docs, "spans")
    held = rows.join(_renamed(spans), _same_document(), "left").select(*(F.col("row")[c].alias(c) for c in docs.columns), F.col("spans").alias(name))
    at = docs.columns.index("text")

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in (x for batch in batches for x in chunks(batch, at, 1 << 22)):
            texts, keep = c.column(at).to_pylist(), []
            for i, spans in enumerate(c.column(c.num_columns - 1).to_pylist()):
                if spans:
                    left = _left(texts[i].encode().split(), spans, window)
                    texts[i] = b" ".join(left).decode()
                    keep.append(bool(left))
                else:
                    keep.append(True)
            cols = [pa.array(texts, pa.string()) if i == at else c.column(i) for i in range(c.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=docs_names).filter(pa.array(keep, pa.bool_()))

    docs_names = to_arrow_schema(docs.schema).names
    out = held.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _left(words: list[bytes], spans: list[dict], window: int) -> list[bytes]:
    """The words outside of the text's factors."""
    out, at = [], 0
    for start, length, *_ in parse(spans, window):
        out += words[at:start]
        at = max(at, start + length)
    return out + words[at:]


def strip_repeats(docs: DataFrame, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """doc_id, tie (hash of the text), n_words, n_removed, kept, kept_sha256 of every row."""
    rows = _store.id_text(docs).withColumn("tie", _tie())
    spans = matches(rows, window, k)
    return _strip(rows.join(_renamed(spans), _same_document(), "left").select("doc_id", "tie", "text", "spans"), window)
