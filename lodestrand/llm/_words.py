"""Words of whole Arrow string columns and rolling hashes of them, as numpy arrays.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D); no byte of a longer UTF-8 character is
one of those.  Hashes are polynomials modulo 2^64 over random per-byte values, made position-free by the inverse of the
base, then mixed; two bases give 128 bits where equality must be certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at a time.
_BLOCK = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of ranges of a sequence of 64-bit values."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.bytes = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = np.uint64(int(rng.integers(1 << 62, 1 << 63)) * 2 + 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A mixed hash of values[s:e] for every range, whatever its place."""
        n = len(values)
        self._reach(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers[:n], dtype=np.uint64, out=total[1:])
        return mix((total[ends] - total[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


FIRST, SECOND = Rolling(1), Rolling(2)


class Words:
    """The words of some texts: byte bounds, the text each bound belongs to, and hashes."""

    def __init__(self, texts: pa.Array):
        if texts.null_count:
            texts = texts.fill_null("")
        self.n_texts = len(texts)
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        at = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2] if len(texts) else None
        self.data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
        self.at = at - at[0]
        n = len(self.data)
        word = ~_SPACE[self.data]
        opens, closes = np.ones(n, bool), np.ones(n, bool)
        opens[1:], closes[:-1] = ~word[:-1], ~word[1:]
        inner = self.at[(self.at > 0) & (self.at < n)]
        opens[inner] = True
        closes[inner - 1] = True
        self.starts, self.ends = np.flatnonzero(word & opens), np.flatnonzero(word & closes) + 1
        #: Words bounds[i]:bounds[i + 1] are those of text i.
        self.bounds = np.searchsorted(self.starts, self.at)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, rolling: Rolling = FIRST) -> np.ndarray:
        out, i = np.empty(len(self), np.uint64), 0
        while i < len(self):
            lo = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, lo + _BLOCK, side="right")))
            block = rolling.bytes[self.data[lo : self.ends[j - 1]]]
            out[i:j] = rolling.ranges(block, self.starts[i:j] - lo, self.ends[i:j] - lo)
            i = j
        return out

    def last(self) -> np.ndarray:
        """For each word, the end of its text's words."""
        return np.repeat(self.bounds[1:], np.diff(self.bounds))


def grams(values: np.ndarray, k: int, rolling: Rolling = FIRST) -> np.ndarray:
    """A hash of every k values in a row (len - k + 1 of them; they may span texts)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = values[:n].copy()
    for j in range(1, k):
        h *= rolling.base
        h += values[j : j + n]
    return mix(h)


def chunks(batch: pa.RecordBatch, column: str | int = "text", size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text, so that arrays stay small; a longer text is a run alone."""
    texts = batch.column(column)
    if not len(texts):
        return
    import pyarrow.compute as pc

    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + size, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
