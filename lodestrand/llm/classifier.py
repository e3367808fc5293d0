"""A quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

A text's statistics (rates of symbols, cases, repeats, word lengths ...) are standardised and mapped by random Fourier
features, whose products approximate a Gaussian kernel.  Each partition of the training rows sums its normal equations
and sends a small matrix for each fold; the sums are added up in two levels and solved by ridge regression, once for all folds and
once without each.  The raw scores are calibrated to probabilities by pool-adjacent-violators on counts of binned scores; a
row's score there is by the weights that were fitted without its fold, so that no row calibrates what it was fitted on.  Only
matrices whose size depends on the number of features, and bounded bins, reach the driver; the corpus is read once, its
statistics are written, and no text is shuffled.

Labels are read from the training rows only, and ``labels``, ``lang``, ``source`` and ``doc_id`` are no inputs.

Defined results: a null text is empty; an empty text has statistics (all zero) and so a score; texts of any length are read whole; a
document with several labels counts each; labels other than 0 and 1 and labels without a doc_id are no labels; without any
training label every score is 0.5; rows without a doc_id are scored and not held out; rows that repeat a doc_id are scored each;
an empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _store
from ._words import chunks
from ._workers import lean

#: Features, kernel width (in standard deviations of a statistic, times the root of their number), ridge, score bins.
FEATURES, WIDTH, RIDGE, BINS, SEED = 192, 1.0, 1e-3, 1000, 7
#: Parts of the training rows; each is calibrated with weights fitted on the others.
PARTS = 3
#: At most this many labelled documents train the model (a hash of doc_id draws them).
TRAIN_ROWS = 2_000_000
_SYMBOLS = b"#*$%&|<>{}[]()=+@^~\\/_"
_PUNCT = b".,;:!?"
_CLASS = np.zeros((256, 7))
_CLASS[[*_SYMBOLS], 0] = 1
_CLASS[[*_PUNCT], 1] = 1
_CLASS[48:58, 2] = 1
_CLASS[65:91, 3] = 1
_CLASS[97:123, 4] = 1
_CLASS[128:, 5] = 1
_CLASS[[9, 10, 11, 12, 13, 32], 6] = 1
N_STATS = 18


def statistics(text: str) -> list[float]:
    """Statistics of a whole text, each a rate or a logarithm."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, w = max(len(raw), 1), max(len(words), 1)
    rates = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASS / n
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    firsts = Counter(lines)
    pairs = Counter(zip(words, words[1:], strict=False)) if len(words) > 1 else Counter()
    return [
        *rates[:6],
        np.log1p(len(raw)),
        np.log1p(len(words)),
        sizes.mean() if len(words) else 0.0,
        sizes.std() if len(words) else 0.0,
        len(counts) / w,
        max(counts.values(), default=0) / w,
        1 - len(firsts) / len(lines) if lines else 0.0,
        len(lines) / w,
        1 - len(pairs) / max(len(words) - 1, 1) if pairs else 0.0,
        sum(x.isupper() for x in words) / w,
        sum(x[-1] in _SYMBOLS for x in words) / w,
        sum(x[-1] in _PUNCT for x in words) / w,
    ]


class Model:
    """Standardisation, directions, weights and calibration; a few hundred kilobytes."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.directions = rng.standard_normal((len(mean), features)) / (width * np.sqrt(len(mean)))
        self.phases = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + len(mean) + 1)
        self.edges, self.values = np.array([0.0]), np.array([0.5])

    def design(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases)), z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.design(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated; linear between the pooled blocks."""
        return np.clip(np.interp(self.raw(stats), self.edges, self.values), 0.0, 1.0)


def isotonic(x: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in ascending x: (centres, non-decreasing rates)."""
    blocks: list[list[float]] = []
    for c, g, t in zip(x, good, total, strict=True):
        blocks.append([c * t, float(g), float(t)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def normal_sums(design: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """What ridge regression needs of some rows, one after another: the weighted Gram matrix, the moment and the number of rows."""
    held = (design * weight[:, None]).T
    return np.concatenate([(held @ design).ravel(), held @ y, [len(y)]])


def ridge(sums: np.ndarray, k: int, strength: float) -> np.ndarray:
    """Weights by the sums of ``normal_sums`` over all rows; the last feature, the constant, is not shrunk."""
    gram, moment, n = sums[: k * k].reshape(k, k), sums[k * k : -1], sums[-1]
    return np.linalg.solve(gram + strength * n * np.diag([*np.ones(k - 1), 1e-9]), moment)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for b in chunks(batch, size=1 << 22):
            yield b, np.array([statistics(t) for t in b.column("text").to_pylist()], np.float64)


def _summed(rows: DataFrame, function, groups: int = 16) -> np.ndarray | None:
    """The sum of one array a partition, by way of a few groups, so that the driver gets a bounded number of arrays."""

    @lean()
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for b in batches:
            s = function(b)
            total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_pydict({"g": pa.array([TaskContext.get().partitionId() % groups], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})

    @lean()
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for m in b.column("m").to_pylist():
                x = np.frombuffer(m, np.float64)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"g": pa.array([0], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})

    kind = "g int, m binary"
    got = rows.mapInArrow(part, kind).repartition(groups, "g").mapInArrow(add, kind).collect()
    return sum(np.frombuffer(r["m"], np.float64) for r in got) if got else None


def fit(stats: DataFrame, labels: DataFrame, held_out: int = 2, folds: int = 4, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled rows whose crc32(doc_id) mod ``folds`` is not ``held_out``; stats: ``document_stats``."""
    own = labels.filter("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("double").alias("y"))
    own = own.filter(F.crc32(F.col("doc_id").cast("string")) % folds != held_out)
    n = own.count()
    if n > train_rows:
        own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * train_rows / n))
    part = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(PARTS)).cast("int")
    stats = _store.materialize(stats.join(own, "doc_id").select("y", "stats", part.alias("part")), "train-stats")

    def matrix(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(b.column("stats").to_pylist(), np.float64).reshape(-1, N_STATS), b.column("y").to_numpy(zero_copy_only=False), b.column("part").to_numpy(zero_copy_only=False)

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x, y, _ = matrix(b)
        return np.concatenate([x.sum(0), (x * x).sum(0), [len(x), y.sum()]])

    m = _summed(stats, moments)
    if m is None or not m[-2]:
        return Model(np.zeros(N_STATS), np.ones(N_STATS))
    mean = m[:N_STATS] / m[-2]
    scale = np.sqrt(np.maximum(m[N_STATS : 2 * N_STATS] / m[-2] - mean**2, 1e-8))
    model = Model(mean, scale)
    k, share = len(model.weights), m[-1] / m[-2]
    balance = np.array([0.5 / max(1 - share, 1e-9), 0.5 / max(share, 1e-9)])  # either class weighs one half

    def normal(b: pa.RecordBatch) -> np.ndarray:
        x, y, parts = matrix(b)
        design, weight = model.design(x), balance[y.astype(int)]
        return np.concatenate([normal_sums(design[parts == p], y[parts == p], weight[parts == p]) for p in range(PARTS)])

    sums = _summed(stats, normal).reshape(PARTS, -1)
    model.weights = ridge(sums.sum(0), k, RIDGE)
    without = [ridge(sums.sum(0) - own_part, k, RIDGE) if (sums.sum(0) - own_part)[-1] else model.weights for own_part in sums]

    def bins(b: pa.RecordBatch) -> np.ndarray:
        x, y, parts = matrix(b)
        raw = np.einsum("ij,ij->i", model.design(x), np.array(without)[parts])
        at = np.clip(np.floor((raw + 1) / 3 * BINS), 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)]).astype(np.float64)

    h = _summed(stats, bins)
    total, good = h[:BINS], h[BINS:]
    there = total > 0
    centres = (np.arange(BINS) + 0.5) / BINS * 3 - 1
    model.edges, model.values = isotonic(centres[there], good[there], total[there])
    return model


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every document: a few numbers each, written once, so that each text is read once."""
    schema = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _rows_of(batches):
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_STATS), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), flat], schema=schema)

    return _store.materialize(_store.id_text(docs).mapInArrow(run, "doc_id long, stats array<double>"), "stats")


def predict(rows: DataFrame, model: Model, stats: str = "stats") -> DataFrame:
    """The columns of rows, with ``stats`` replaced by score."""
    keep = [c for c in rows.columns if c != stats]
    held = rows.select(*keep, stats)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(b.num_columns - 1).to_pylist(), np.float64).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(shared.value.score(x))], names=[*keep, "score"])

    return held.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in held.dtypes[:-1]) + ", score double")


def score_texts(docs: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """All columns of docs and ``score`` (replacing one of that name), in one pass over the texts and without a shuffle.

    A text crosses to the worker once, in its own column; a batch of a second copy would double the memory on both sides.
    """
    import pyarrow.compute as pc
    from pyspark.sql.types import StructType

    shared = docs.sparkSession.sparkContext.broadcast(model)
    held = docs.drop(score) if score in docs.columns else docs
    names, at = [*held.columns, score], [c.lower() for c in held.columns].index("text")

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (c for batch in batches for c in chunks(batch, at, 1 << 22)):
            x = np.array([statistics(t) for t in pc.fill_null(b.column(at), "").to_pylist()], np.float64).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.score(x))], names=names)

    return held.mapInArrow(run, StructType(list(held.schema.fields)).add(score, "double"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    stats = document_stats(docs)
    scored = predict(stats, fit(stats, labels))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
