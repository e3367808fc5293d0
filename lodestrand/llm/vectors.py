"""Near-duplicate vectors by sorted projection passes.

Each pass gives every vector a key, the signs of its projections on the pass's random directions one after another, and
orders all vectors by it.  Vectors are centred on the mean before they are projected, as vectors of one domain share a direction that would
share the leading bits of all.  A vector is compared with its next neighbours in that order, a bounded window.  Vectors at a
small angle share long key prefixes in some pass.  Pairs of all passes are united, verified in double precision, and
their components are the classes.  Equal keys are ordered by a hash of the pass's own, and the rows at the edges of tasks are
compared once more, a pass together, so that no window ends at an edge.

How many passes are enough is measured: partners at the limit are made for a bounded sample of the vectors, and in some passes the
vectors between the two are counted, in more of them where few hold.  Tables of every size go by passes alone; who wants all vectors compared, in salted
blocks, asks for it (``passes=0``).

Windows only find the components.  Links are counted afterwards among all members of each component, in pairs of salted
blocks, so a vector may have any number of them.

Equal vectors are one node from the start, so a vector held by a third of all rows is one row in every pass.  What travels
with the keys is a copy of the vector in signed bytes; its rounding error is bounded, and a neighbour is
dropped only where that bound rules a link out.  The exact cosine is computed on the vectors themselves.

Defined results: a vector that is null, empty, all zero or holds a null or non-finite component links with nothing, not
even its copies; vectors of different lengths do not link; rows that repeat a vec_id are separate vectors with one class
id; a null vec_id is a vector like any other, and names a class only if all of it are null; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _graph, _store

SIMILARITY, WINDOW, BITS = 0.9, 48, 64
#: Members of a component compared at a time, at least.
BLOCK = 256
#: The chance that a pair at the limit is found in some pass; the number of passes follows from it.
RECALL = 0.995
#: Vectors that partners are made for, and passes in which these are looked for: the second number where the first finds few.
PROBES, PROBED = 256, (32, 256)
NODE = "node binary, vector binary"


def _unit(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None where a vector links with nothing."""
    out = []
    for v in column.to_pylist():
        x = None if not v or any(c is None for c in v) else np.asarray(v, np.float64)
        if x is not None and np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
            x = x / top
            out.append(x / np.sqrt(x @ x))
        else:
            out.append(None)
    return out


def nodes(rows: DataFrame, vector: str) -> DataFrame:
    """vec_id, node (128 bits of the vector's direction; null: links with nothing), vector (float64 bytes)."""
    schema = pa.schema([("vec_id", pa.int64()), ("node", pa.binary()), ("vector", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [x if x is None else x.tobytes() for x in _unit(b.column(1))]
            keys = [r and hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], schema=schema)

    return rows.select("vec_id", vector).mapInArrow(run, "vec_id long, node binary, vector binary")


def passes_for(n: int, similarity: float = SIMILARITY, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes that find a pair at the limit among n vectors with the given chance.

    A window of w spans the vectors that share about log2(n / w) leading bits, and a pair shares each bit with a chance of one
    minus its angle over pi.  The number grows as a small power of n (0.22 at a cosine of 0.9).
    """
    same = 1 - math.acos(similarity) / math.pi
    once = same ** math.log2(max(n / window, 2))
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-once)))


def _directions(d: int, p: int) -> np.ndarray:
    return np.random.default_rng([d, p]).standard_normal((d, BITS))


def _by_length(raw: list[bytes]):
    """Vectors of one length together: (places, matrix)."""
    sizes = np.array([len(r) for r in raw])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield at, np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)


def means(table: DataFrame) -> dict[int, np.ndarray]:
    """The mean of the vectors of each length, by partial sums; a task sends one row a length."""
    schema = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for at, x in _by_length(b.column("vector").to_pylist()):
                held = sums.setdefault(x.shape[1], [0, np.zeros(x.shape[1])])
                held[0], held[1] = held[0] + len(at), held[1] + x.sum(0)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()]), pa.array([t.tolist() for _, t in sums.values()], pa.list_(pa.float64()))], schema=schema)

    each = table.select("vector").mapInArrow(run, "d int, n long, total array<double>").select("d", "n", F.posexplode("total").alias("i", "x"))
    rows = each.groupBy("d", "i").agg((F.sum("x") / F.sum("n")).alias("m")).groupBy("d").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("m"))  # a length's components
    return {r.d: np.array([m for _, m in r.m]) for r in rows.collect()}


def _keys(x: np.ndarray, mean: np.ndarray | None, p: int) -> np.ndarray:
    """The keys of a pass, in signed order."""
    weight = np.uint64(1) << np.arange(BITS, dtype=np.uint64)[::-1]
    key = (((x if mean is None else x - mean) @ _directions(x.shape[1], p) > 0) * weight).sum(1, dtype=np.uint64)
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def _hits(table: DataFrame, probes: list[tuple[np.ndarray, np.ndarray]], mean: dict[int, np.ndarray], window: int, probed: int) -> np.ndarray:
    """For each pair of vectors, in how many of the passes less than a window of the table's vectors lies between the two."""
    lengths = {len(x) for x, _ in probes}
    ends = {}
    for d in lengths:
        own = [i for i, (x, _) in enumerate(probes) if len(x) == d]
        both = [np.stack([probes[i][k] for i in own]) for k in (0, 1)]
        for p in range(probed):
            a, b = (_keys(x, mean.get(d), p) for x in both)
            ends[d, p] = own, np.minimum(a, b), np.maximum(a, b)
    schema = pa.schema([("at", pa.int32()), ("between", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((probed, len(probes)), np.int64)
        for b in batches:
            for _, x in _by_length(b.column("vector").to_pylist()):
                for p in range(probed if x.shape[1] in lengths else 0):
                    own, lo, hi = ends[x.shape[1], p]
                    key = np.sort(_keys(x, mean.get(x.shape[1]), p))
                    total[p, own] += np.searchsorted(key, hi) - np.searchsorted(key, lo, "right")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], schema=schema)

    between = np.zeros(probed * len(probes), np.int64)
    for r in table.select("vector").mapInArrow(run, "at int, between long").groupBy("at").agg(F.sum("between").alias("n")).collect():
        between[r["at"]] = r.n
    return (between.reshape(probed, -1) < window).sum(0)


def measured_passes(table: DataFrame, n: int, mean: dict[int, np.ndarray], similarity: float, window: int, recall: float = RECALL) -> tuple[int, bool]:
    """(passes that find a partner at the limit with the given chance, on average over a sample of the vectors; whether they cost less than comparing all).

    A pass finds it if no more than a window of vectors lies between the two; of how many passes that holds is counted for each.
    A partner that no pass finds counts as found by a quarter of one, so the number of passes has a bound at any size.
    """
    probes = []
    for r in table.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(PROBES).collect():
        x = np.frombuffer(r.vector)
        z = np.random.default_rng([len(probes), len(x)]).standard_normal(len(x))
        z -= (z @ x) * x
        if len(x) > 1:
            probes.append((x, similarity * x + np.sqrt(1 - similarity**2) * z / np.sqrt(z @ z)))
    if not probes:
        return 1, True
    for probed in PROBED:
        rate = (_hits(table, probes, mean, window, probed) + 0.25) / (probed + 0.5)
        k = passes_for(n, similarity, window, recall)
        while np.mean((1 - rate) ** k) > 1 - recall:
            k += max(1, k // 8)
        if k <= 16 * probed:  # at 21 times, partners that were never found decide the number
            break
    return k, 2 * window * k < n


def _keyed(table: DataFrame, passes: int, mean: dict[int, np.ndarray] | None = None) -> DataFrame:
    """pass, key, node, code of every node and pass; code: the scale, then the components in signed bytes."""
    schema, mean = pa.schema([("pass", pa.int32()), ("key", pa.int64()), ("node", pa.binary()), ("code", pa.binary())]), mean or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("node").to_pylist()
            for at, x in _by_length(b.column("vector").to_pylist()):
                scale = np.abs(x).max(1) / 127
                codes = [s.tobytes() + q.tobytes() for s, q in zip(scale, np.rint(x / scale[:, None]).astype(np.int8), strict=True)]
                own, codes = pa.array([ids[i] for i in at], pa.binary()), pa.array(codes, pa.binary())
                for p in range(passes):
                    key = _keys(x, mean.get(x.shape[1]), p)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), p, np.int32)), pa.array(key), own, codes], schema=schema)

    return table.mapInArrow(run, "pass int, key long, node binary, code binary")


FOUND = "a binary, b binary, pass int, key long, tie long, node binary, code binary"


def _spanning(sure: list[tuple], unsure: list[tuple]) -> list[tuple]:
    """Pairs with the same components, whichever of the unsure ones are links: a forest of the sure ones, and unsure ones between its trees."""
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    out = []
    for u, v in sure:
        if (x := find(u)) != (y := find(v)):
            root[x] = y
            out.append((u, v))
    return out + [(u, v) for u, v in unsure if find(u) != find(v)]


def _neighbours(ordered: DataFrame, window: int, similarity: float) -> DataFrame:
    """Pairs a < b within the window that the rounded vectors don't rule out, as many as their components need; then the first
    and last ``window`` rows of the task, where a and b are null."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("pass", pa.int32()), ("key", pa.int64()), ("tie", pa.int64()), ("node", pa.binary()), ("code", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list[tuple] = []
        tail: list[tuple] = []  # the last rows of the batches before
        total = 0
        for c in batches:
            own = list(zip(*(c.column(n).to_pylist() for n in ("pass", "node", "code", "key", "tie")), strict=True))
            rows, fresh = tail + own, len(tail)
            tail, total = rows[-window:], total + len(own)
            head += own[: max(0, window - len(head))]
            passes, sizes = np.array([r[0] for r in rows]), np.array([len(r[2]) for r in rows])
            sure, unsure = set(), set()
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                raw = np.frombuffer(b"".join(rows[i][2] for i in at), np.uint8).reshape(len(at), n)
                scale = np.ascontiguousarray(raw[:, :8]).view(np.float64).ravel()
                x = raw[:, 8:].view(np.int8).astype(np.float32) * scale[:, None].astype(np.float32)
                # |x - v| <= scale * sqrt(d) / 2 for each of the two, all of length about 1.
                slack = scale * np.sqrt(x.shape[1]) / 2
                for step in range(1, min(window, len(at) - 1) + 1):
                    lo, hi = at[:-step], at[step:]
                    ok = (passes[lo] == passes[hi]) & (hi >= fresh) & (hi - lo <= window)
                    dot = np.einsum("ij,ij->i", x[:-step], x[step:])
                    room = slack[:-step] + slack[step:] + slack[:-step] * slack[step:] + 1e-5
                    for i in np.flatnonzero(ok & (dot >= similarity - room)):
                        u, v = rows[lo[i]][1], rows[hi[i]][1]
                        if u != v:
                            (sure if dot[i] >= similarity + room[i] else unsure).add((u, v) if u < v else (v, u))
            if found := _spanning(sorted(sure), sorted(unsure)):
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), *(pa.nulls(len(a), f.type) for f in list(schema)[2:])], schema=schema)
        edge = head + tail[max(0, len(head) + len(tail) - total) :]
        if edge:
            p, node, code, key, tie = zip(*edge, strict=True)
            cols = [pa.nulls(len(edge), pa.binary())] * 2 + [pa.array(v, f.type) for v, f in zip((p, key, tie, node, code), list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return ordered.mapInArrow(run, FOUND)


def _in_order(keyed: DataFrame) -> DataFrame:
    return keyed.sortWithinPartitions("pass", "key", "tie", "node")


def _pairs(keyed: DataFrame, window: int, similarity: float) -> DataFrame:
    """Distinct pairs a < b of all passes, over the edges of tasks too."""
    keyed = keyed.withColumn("tie", F.xxhash64("pass", "node"))
    found = _neighbours(_in_order(keyed.repartitionByRange("pass", "key", "tie", "node")), window, similarity)
    found = _store.materialize(found.distinct(), "pairs")
    # A task's first and last rows stand for it: those of the next task follow its last ones.
    edges = found.filter("a is null").select("pass", "key", "node", "code", "tie")
    over = _neighbours(_in_order(edges.repartition("pass")), window, similarity)
    return found.select("a", "b").unionByName(over.select("a", "b")).filter("a is not null").distinct()


ORDER = ("component", "lo", "hi")


def _dealt(members: DataFrame) -> DataFrame:
    """Members (component, node, vector, copies) so that every two of a component meet in a group of rows (``ORDER``).

    A component is dealt into blocks by a hash; second: of the two blocks of a group the second one.
    """
    size = members.groupBy("component").agg(F.count(F.lit(1)).alias("_m"))
    blocks = F.ceil(F.col("_m") / F.greatest(F.lit(float(BLOCK)), 8 * F.sqrt("_m"))).cast("int")
    held = members.join(size.select("component", blocks.alias("_k")), "component").withColumn("_i", F.pmod(F.xxhash64("node"), F.col("_k")).cast("int"))
    held = held.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    held = held.select("component", F.least("_i", "_j").alias("lo"), F.greatest("_i", "_j").alias("hi"), (F.col("_i") > F.col("_j")).alias("second"), "node", "vector", "copies")
    return held.repartition(*ORDER).sortWithinPartitions(*ORDER)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, bool]]:
    """Rows (node, vector, copies) of the two blocks of each group, and whether they are one block."""
    last, rows = None, []

    def parted() -> tuple[list, list, bool]:
        one, two = [r[1:] for r in rows if not r[0]], [r[1:] for r in rows if r[0]]
        return (one, one, True) if last[1] == last[2] else (one, two, False)

    for c in batches:
        for *at, second, node, vector, copies in zip(*(c.column(n).to_pylist() for n in (*ORDER, "second", "node", "vector", "copies")), strict=True):
            if at != last:
                if rows:
                    yield parted()
                last, rows = at, []
            rows.append((second, node, vector, copies))
    if rows:
        yield parted()


def _near(one: list, two: list, same: bool, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of the links between two blocks: the first row, then a matrix of which are links."""
    x, y = (np.frombuffer(b"".join(r[1] for r in part)).reshape(len(part), -1) for part in (one, two))
    for k in range(0, len(one), 512):
        near = x[k : k + 512] @ y.T >= similarity
        if same:
            near[np.arange(len(near)), np.arange(k, k + len(near))] = False
        yield k, near


def _counted(members: DataFrame, similarity: float) -> DataFrame:
    """node, others: the rows (``copies``) of the other nodes of its component that link with it, by comparing all of them."""
    schema = pa.schema([("node", pa.binary()), ("others", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two, same in _groups(batches):
            if not one or not two:
                continue
            wx, wy = (np.array([r[2] for r in part], np.int64) for part in (one, two))
            own, other = np.zeros(len(one), np.int64), np.zeros(len(two), np.int64)
            for k, near in _near(one, two, same, similarity):
                own[k : k + len(near)] = near @ wy
                other += wx[k : k + len(near)] @ near
            for part, n in ((one, own),) if same else ((one, own), (two, other)):
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.binary()), pa.array(n)], schema=schema)

    return _dealt(members).mapInArrow(run, "node binary, others long").groupBy("node").agg(F.sum("others").alias("others"))


def _all_links(table: DataFrame, similarity: float) -> DataFrame:
    """Links a, b of all nodes of equal length, as many as their components need."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two, same in _groups(batches):
            if not one or not two:
                continue
            # A forest: of a row's links one to each tree that it is not in yet.
            shift = 0 if same else len(one)
            tree, found = np.arange(shift + len(two)), []
            for k, near in _near(one, two, same, similarity):
                for i in np.flatnonzero(near.any(1)):
                    j = np.flatnonzero(near[i])
                    trees, at = np.unique(tree[shift + j], return_index=True)
                    for t, x in zip(trees.tolist(), j[at].tolist(), strict=True):
                        if t != tree[k + i]:
                            found.append((one[k + i][0], two[x][0]))
                            tree[tree == t] = tree[k + i]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found, strict=True)], schema=schema)

    return _dealt(table.select(F.length("vector").alias("component"), "node", "vector", F.lit(1).cast("long").alias("copies"))).mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, table: DataFrame, similarity: float) -> DataFrame:
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in batches:
            good = [len(u) == len(v) and float(np.frombuffer(u) @ np.frombuffer(v)) >= similarity for u, v in zip(c.column("va").to_pylist(), c.column("vb").to_pylist(), strict=True)]
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.column("a").filter(keep), c.column("b").filter(keep)], schema=schema)

    left = pairs.join(table.select(F.col("node").alias("a"), F.col("vector").alias("va")), "a")
    both = left.join(table.select(F.col("node").alias("b"), F.col("vector").alias("vb")), "b")
    return both.select("a", "b", "va", "vb").mapInArrow(run, "a binary, b binary")


def near_vectors(rows: DataFrame, vector: str = "embedding", similarity: float = SIMILARITY, passes: int | None = None, window: int = WINDOW) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; passes: by ``measured_passes`` unless given; 0: all vectors are compared, exact and quadratic."""
    all_rows = _store.materialize(nodes(rows, vector), "vectors")
    table = all_rows.filter("node is not null").groupBy("node").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    table = _store.materialize(table, "vector-nodes")
    n, mean = table.count(), means(table)
    if passes is None:
        passes, _ = measured_passes(table, n, mean, similarity, window)
    if passes:
        found = _verified(_pairs(_keyed(table.select("node", "vector"), passes, mean), window, similarity), table.select("node", "vector"), similarity)
    else:
        found = _all_links(table, similarity)
    links = _store.materialize(found, "links")
    parts = _store.materialize(_graph.components(links), "components")
    direct = _counted(parts.join(table.select("node", "vector", "copies"), "node"), similarity)
    known = table.select("node", "copies", "least").join(direct, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    class_ids = known.groupBy("component").agg(F.min("least").alias("class_id"))
    known = known.join(class_ids, "component").select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), "class_id")
    out = all_rows.select("vec_id", "node").join(known, "node", "left")
    class_id = F.coalesce("class_id", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), class_id.alias("component_id"), F.col("vec_id").eqNullSafe(class_id).alias("kept"))
