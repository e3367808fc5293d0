"""Piece encoding with the N best segmentations of every text.

The text is normalised (white space runs to one piece mark, one in front) and its segmentations are the paths of a lattice:
edges are vocabulary pieces with their scores; a character that no piece covers is its UTF-8 byte pieces, at a penalty.  A forward
Viterbi pass gives the best score of every prefix.  Those scores are exact heuristics for an A-star search that grows
hypotheses backward from the end: a hypothesis' priority is the score of its suffix plus the best score of the prefix that
is left, which is the score of its best completion, so completed paths leave the agenda in order of score.

No piece crosses a word's start, so the lattice of a text is a chain of word lattices.  For each distinct word the forward pass
and its mirror give the best path and, exactly, how much the second best costs more: the least loss over all edges
that the best path does not use.  A text's N best paths change only words among the N with the least such cost, so
only those are searched further by A-star; the N best of the chain are then found best first, from these words' own lists.
Words are kept in bounded memos.

The two passes run over the new words of many texts at a time, as arrays: pieces are found by steps in a trie from every place at
once, and edges are taken by place in the word, then length, so that no two of a step meet in one place.  The results are those
of one word at a time, which is how words with very long parts go (scores of 32 bits sum without rounding).

Ties are broken by the order of search, which depends on the text alone.

Defined results: a null text is empty; an empty or white text has one segmentation, without pieces; texts of any length are encoded
whole; repeated rows and rows without a doc_id are encoded each; an empty table gives no row; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import heapq
import math
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _store
from ._words import chunks

MARK = "▁"
#: Words kept by a worker, and how far below the worst piece an uncovered character scores.
MEMO, PENALTY = 1_000_000, 10.0
#: Words with a part beyond this many characters, or fewer words than this, go one at a time; characters of words taken at a time.
LONG, FEW, RUN = 40, 64, 1 << 17
Path = tuple[float, tuple[int, ...]]
Best = tuple[bytes, float, float, bool]


class Table:
    """Values (32-bit, not negative) of distinct keys (63-bit), looked up many at a time by open addressing; -1: no such key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = int(4 * len(keys) + 4).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            at, first = np.unique(slot[free], return_index=True)
            self.keys[at], self.values[at] = keys[free[first]], values[free[first]]
            left = np.setdiff1d(left, free[first])
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            held = self.keys[slot[left]]
            hit = held == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out


class Column:
    """An array that grows at its end."""

    def __init__(self, kind: str):
        self.held, self.n = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            held = np.empty(max(self.n + len(more), 3 * len(self.held) // 2), self.held.dtype)
            held[: self.n] = self.held[: self.n]
            self.held = held
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class Lattice:
    """N-best segmentation under a piece vocabulary."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int], n_best: int = 5):
        self.scores, self.byte_ids, self.n_best = scores, byte_ids, n_best
        self.floor = min((s for _, s in scores.values()), default=0.0) - PENALTY
        #: Every prefix of a piece; whole pieces with id and score.
        self.prefixes: dict[str, tuple[int, float] | None] = {p[:i]: None for p in scores for i in range(1, len(p))} | scores
        #: Characters that stand side by side in some piece.
        self.pairs = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}
        self.raw = {i: p.encode("utf-8", "surrogatepass") for p, (i, _) in scores.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        #: Word -> its row in the columns.
        self.memo: dict[str, int] = {}
        self._empty()
        self.searched: dict[str, list[Path]] = {}
        # The prefixes as a trie: node 0 is empty, a key is a node and the next character.
        node = {"": 0} | {p: i for i, p in enumerate(self.prefixes, 1)}
        self.trie = Table(np.array([node[p[:-1]] << 21 | ord(p[-1]) for p in self.prefixes], np.int64), np.arange(1, len(node), dtype=np.int32))
        self.node_id = np.array([-1, *(hit[0] if hit else -1 for hit in self.prefixes.values())], np.int64)
        self.node_score = np.array([self.floor, *(hit[1] if hit else 0.0 for hit in self.prefixes.values())], np.float64)
        self.pair_table = Table(np.array([ord(p[0]) << 21 | ord(p[1]) for p in self.pairs], np.int64), np.zeros(len(self.pairs), np.int32))

    @classmethod
    def load(cls, path: str, n_best: int = 5) -> Lattice:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and MARK not in piece[1:]:
                pieces[piece] = (i, sp.get_score(i))
        return cls(pieces, byte_ids, n_best)

    def _bytes(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[x] for x in char.encode("utf-8", "surrogatepass"))

    def all_edges(self, word: str) -> list[tuple[int, int, int, float]]:
        """Edges (start, end, id, score) in order of start; id -1: the bytes of one uncovered character."""
        out, get, n = [], self.prefixes.get, len(word)
        floor = self.floor
        for a in range(n):
            one = False
            b = a + 1
            while b <= n:
                part = word[a:b]
                hit = get(part, 0)
                if hit:
                    out.append((a, b, hit[0], hit[1]))
                    one = one or b == a + 1
                elif hit == 0:
                    break
                b += 1
            if not one:
                out.append((a, a + 1, -1, floor))
        return out

    def edges(self, word: str, end: int) -> list[tuple[int, tuple[int, ...], float]]:
        """The edges (start, ids, score) into ``end``."""
        return [(a, (i,) if i >= 0 else self._bytes(word[a]), s) for a, b, i, s in self._into(word)[end]]

    def _into(self, word: str) -> list[list[tuple[int, int, int, float]]]:
        into: list[list] = [[] for _ in range(len(word) + 1)]
        for e in self.all_edges(word):
            into[e[1]].append(e)
        return into

    def _empty(self) -> None:
        """Forget all words.  Columns: where the ids of the best path end, its score, what the second best costs more, whether the ids spell the word; all ids."""
        self.memo.clear()
        self.ends, self.score, self.loss, self.same, self.ids = map(Column, ("i8", "f8", "f8", "?", "<u4"))
        self.ends.add(np.zeros(1, np.int64))  # row r has the ids ends[r]:ends[r + 1]

    def know(self, texts: list[list[str]]) -> None:
        """Put the best paths of all words of some texts into the memo, which is emptied first if it would grow beyond ``MEMO``."""
        words = set().union(*texts)
        new = words.difference(self.memo)
        if len(self.memo) + len(new) > MEMO:
            self._empty()
            new = words
        if len(new) < FEW:
            self._one_by_one(list(new))
            return
        new = list(new)
        sizes = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1)
        cuts = [0, *(np.flatnonzero(np.diff(sizes // RUN)) + 1).tolist(), len(new)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            self._one_by_one(self._together(new[x:y]))

    def _keep(self, words: list[str], counts: np.ndarray, ids: np.ndarray, score: np.ndarray, loss: np.ndarray, same: np.ndarray) -> None:
        self.memo.update(zip(words, range(self.score.n, self.score.n + len(words)), strict=True))
        self.ends.add(self.ids.n + np.cumsum(counts))
        for column, more in ((self.ids, ids), (self.score, score), (self.loss, loss), (self.same, same)):
            column.add(more)

    def _one_by_one(self, words: list[str]) -> None:
        if words:
            packed, score, loss, same = zip(*(self.best(MARK + w) for w in words), strict=True)
            self._keep(words, np.array(list(map(len, packed))) // 4, np.frombuffer(b"".join(packed), "<u4"), np.array(score), np.array(loss), np.array(same))

    def best(self, word: str) -> Best:
        """(packed ids, score, loss of the second best, whether the ids spell the word) of one word.

        No edge crosses a place whose two characters stand side by side in no piece, so a word is cut there; its second
        best path changes one cut alone.
        """
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.pairs]
        known: dict[str, Best] = {}
        parts = []
        for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True):
            part = word[a:b]
            if part not in known:
                known[part] = self._best(part)
            parts.append(known[part])
        if len(parts) == 1:
            return parts[0]
        return b"".join([p[0] for p in parts]), sum([p[1] for p in parts]), min([p[2] for p in parts]), all([p[3] for p in parts])

    def _together(self, words: list[str]) -> list[str]:
        """What ``best`` gives, for words together; returns those with a part beyond ``LONG``, which are left."""
        marked = [MARK + w for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(words))
        text = "".join(marked)
        chars, ends = code_points(text), np.cumsum(sizes)
        # Parts: where no piece crosses.
        opens = np.zeros(len(chars), bool)
        opens[1:] = self.pair_table.get(chars[:-1] << 21 | chars[1:]) < 0
        opens[ends - sizes] = True
        start = np.flatnonzero(opens)
        size = np.diff(start, append=len(chars))
        long = start[size > LONG]
        if len(long):
            far = set(np.searchsorted(ends, long, side="right").tolist())
            near = [w for i, w in enumerate(words) if i not in far]
            return [words[i] for i in far] + (self._together(near) if near else [])
        n = len(start)
        part, stop = np.repeat(np.arange(n), size), np.repeat(start + size, size)
        # Edges: the place of the first character, the length and the trie's node; node 0 for an uncovered character.
        live, node, length, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0, []
        covered = np.zeros(len(chars), bool)
        while len(live):
            inside = live + length < stop[live]
            live, node = live[inside], node[inside]
            node = self.trie.get(node << 21 | chars[live + length]).astype(np.int64)
            live, node = live[node >= 0], node[node >= 0]
            length += 1
            whole = self.node_id[node] >= 0
            found.append((live[whole], np.full(int(whole.sum()), length), node[whole]))
            if length == 1:
                covered[live[whole]] = True
        bare = np.flatnonzero(~covered)
        found.append((bare, np.ones(len(bare), np.int64), np.zeros(len(bare), np.int64)))
        first, length, node = map(np.concatenate, zip(*found, strict=True))
        step = (first - start[part[first]]) * (LONG + 1) + length
        order = np.argsort(step, kind="stable")
        first, length, node, step = first[order], length[order], node[order], step[order]
        own, scores = part[first], self.node_score[node]
        # A part of k characters has k + 1 places.
        a = first + own
        b = a + length
        begin, close = start + np.arange(n), start + size + np.arange(n)
        bounds = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(step)]
        steps = [slice(x, y) for x, y in zip(bounds, bounds[1:], strict=False)]
        front, back = np.full(len(chars) + n, -np.inf), np.full(len(chars) + n, -np.inf)
        by, at = np.full(len(chars) + n, -1, np.int64), np.arange(len(a))
        front[begin] = back[close] = 0.0
        for x in steps:
            t, to = front[a[x]] + scores[x], b[x]
            more = t > front[to]
            front[to[more]], by[to[more]] = t[more], at[x][more]
        through = np.empty(len(a))
        for x in reversed(steps):
            t, of = back[b[x]] + scores[x], a[x]
            back[of] = np.maximum(back[of], t)
            through[x] = t + front[of]
        used, here, to = np.zeros(len(a), bool), close, begin
        while len(here):
            e = by[here]
            used[e] = True
            here = a[e]
            on = here > to
            here, to = here[on], to[on]
        second = np.full(n, -np.inf)
        np.maximum.at(second, own[~used], through[~used])
        score, loss = front[close], front[close] - second
        # The ids in order; an uncovered character is its bytes.
        path = np.flatnonzero(used)
        path = path[np.argsort(first[path])]
        ids = self.node_id[node[path]]
        bare = np.flatnonzero(ids < 0)
        width = np.ones(len(ids), np.int64)
        if len(bare):
            spelt = [self._bytes(text[i]) for i in first[path[bare]].tolist()]
            width[bare] = list(map(len, spelt))
            ids = np.repeat(ids, width)
            ids[ids < 0] = [i for x in spelt for i in x]
        word = np.searchsorted(ends, first[path], side="right")
        counts = np.bincount(word, width, len(words)).astype(np.int64)
        head = np.searchsorted(start, ends - sizes)  # each word's first part
        raw = [self.raw[i] for i in ids.tolist()]
        spells, cuts = b"".join(raw), np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))])[np.concatenate([[0], np.cumsum(counts)])]
        nbytes = np.add.reduceat(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000), ends - sizes)
        if spells == text.encode("utf-8", "surrogatepass") and (np.diff(cuts) == nbytes).all():
            same = np.ones(len(words), bool)
        else:
            same = np.array([spells[x:y] == w.encode("utf-8", "surrogatepass") for w, x, y in zip(marked, cuts.tolist(), cuts[1:].tolist(), strict=False)])
        self._keep(words, counts, ids, np.add.reduceat(score, head), np.minimum.reduceat(loss, head), same)
        return []

    def _best(self, word: str) -> Best:
        """One word (or part of one) by the forward pass and its mirror."""
        n, get, low = len(word), self.prefixes.get, float("-inf")
        front, back, by, edges = [low] * (n + 1), [low] * (n + 1), [None] * (n + 1), []
        front[0] = back[n] = 0.0
        for a in range(n):
            reach, one, b = front[a], False, a + 1
            while b <= n:
                hit = get(word[a:b], 0)
                if hit:
                    t = reach + hit[1]
                    edge = (a, b, hit[0], hit[1])
                    edges.append(edge)
                    if t > front[b]:
                        front[b], by[b] = t, edge
                    if b == a + 1:
                        one = True
                elif hit == 0:
                    break
                b += 1
            if not one:
                edge = (a, a + 1, -1, self.floor)
                edges.append(edge)
                if reach + self.floor > front[a + 1]:
                    front[a + 1], by[a + 1] = reach + self.floor, edge
        path, at = [], n
        while at:
            path.append(by[at])
            at = by[at][0]
        path.reverse()
        used, second = set(path), low
        for e in reversed(edges):
            a, b, _, s = e
            t = back[b] + s
            if t > back[a]:
                back[a] = t
            t += front[a]
            if t > second and e not in used:
                second = t
        ids: list[int] = []
        for e in path:
            ids += (e[2],) if e[2] >= 0 else self._bytes(word[e[0]])
        same = b"".join([self.raw[i] for i in ids]) == word.encode("utf-8", "surrogatepass")
        return struct.pack(f"<{len(ids)}I", *ids), front[n], front[n] - second, same

    def search(self, word: str) -> list[Path]:
        """The n_best paths of one word, best first: (score, ids)."""
        into = self._into(word)
        best = [0.0] * (len(word) + 1)
        for b in range(1, len(word) + 1):
            best[b] = max(best[a] + s for a, _, _, s in into[b])
        # Priority: minus (prefix's best + suffix's score), then the shorter prefix, so that ties end soon.  A suffix is a
        # chain of (edge, rest).
        order = count()
        agenda = [(-best[-1], len(word), next(order), None, 0.0)]
        found: list[Path] = []
        while agenda and len(found) < self.n_best:
            _, at, _, chain, suffix = heapq.heappop(agenda)
            if at:
                for e in into[at]:
                    heapq.heappush(agenda, (-(best[e[0]] + e[3] + suffix), e[0], next(order), (e, chain), e[3] + suffix))
                continue
            ids: list[int] = []
            while chain:
                e, chain = chain
                ids += (e[2],) if e[2] >= 0 else self._bytes(word[e[0]])
            found.append((suffix, tuple(ids)))
        return found

    def paths(self, word: str) -> list[Path]:
        got = self.searched.get(word)
        if got is None:
            if len(self.searched) >= MEMO // 20:
                self.searched.clear()
            got = self.searched[word] = self.search(word)
        return got

    def segment(self, text: str) -> tuple[list[float], list[bytes], bool]:
        """(scores, packed ids) of the n_best segmentations of a whole text, best first; whether the best one spells the text: each of its words does."""
        words = [split_words(text)]
        self.know(words)
        return next(self.chains(words))

    def chains(self, texts: list[list[str]]) -> Iterator[tuple[list[float], list[bytes], bool]]:
        """The same of some texts' words, all of them in the memo."""
        bounds = [0, *accumulate(map(len, texts))]
        rows = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(texts)), np.int64, bounds[-1])
        starts, counts = self.ends.held[rows], self.ends.held[rows + 1] - self.ends.held[rows]
        ends = np.concatenate([[0], np.cumsum(counts)])
        packed = self.ids.held[np.repeat(starts - ends[:-1], counts) + np.arange(ends[-1])].tobytes()
        score, loss, same = self.score.held[rows], self.loss.held[rows], self.same.held[rows]
        for words, lo, hi in zip(texts, bounds, bounds[1:], strict=False):
            places = 4 * ends[lo : hi + 1]
            yield self._chain(words, math.fsum(score[lo:hi].tolist()), loss[lo:hi], packed[places[0] : places[-1]], places - places[0], bool(same[lo:hi].all()))

    def _chain(self, words: list[str], total: float, loss: np.ndarray, first: bytes, places: np.ndarray, exact: bool) -> tuple[list[float], list[bytes], bool]:
        # Only the n_best cheapest single changes can take part in the n_best paths; equal ones in order.
        order = np.arange(len(words))
        if len(words) > self.n_best:
            order = np.flatnonzero(loss <= np.partition(loss, self.n_best - 1)[self.n_best - 1])
        order = [w for w in order[np.argsort(loss[order], kind="stable")][: self.n_best].tolist() if loss[w] < math.inf]
        if not order or self.n_best < 2:
            return [total], [first], exact
        spans = {w: (int(places[w]), int(places[w + 1])) for w in order}
        lists = [self.paths(MARK + words[w]) for w in order]
        agenda, seen, scores, packed = [(0.0, (0,) * len(order))], set(), [], []
        while agenda and len(scores) < self.n_best:
            cost, pick = heapq.heappop(agenda)
            if pick in seen:
                continue
            seen.add(pick)
            own = first
            for w, own_paths, p in sorted(zip(order, lists, pick, strict=True), reverse=True):
                if p:  # later words first, so that earlier places stay
                    ids = own_paths[p][1]
                    own = own[: spans[w][0]] + struct.pack(f"<{len(ids)}I", *ids) + own[spans[w][1] :]
            scores.append(total - cost)
            packed.append(own)
            for k, own_paths in enumerate(lists):
                if pick[k] + 1 < len(own_paths):
                    heapq.heappush(agenda, (cost + own_paths[pick[k]][0] - own_paths[pick[k] + 1][0], (*pick[:k], pick[k] + 1, *pick[k + 1 :])))
        return scores, packed, exact

    def encode(self, text: str) -> list[tuple[float, list[int]]]:
        """The n_best segmentations of a whole text, best first."""
        scores, packed, _ = self.segment(text)
        return [(s, np.frombuffer(p, "<u4").tolist()) for s, p in zip(scores, packed, strict=True)]


def split_words(text: str) -> list[str]:
    """Words between white space; a piece mark in the text itself counts as white space."""
    return text.replace(MARK, " ").split() if MARK in text else text.split()


def normalised_words(text: str) -> list[str]:
    """Words with the piece mark in front."""
    return [MARK + w for w in split_words(text)]


def normalised(text: str) -> str:
    return " ".join(split_words(text))


class Decoder:
    """Ids back to normalised text."""

    def __init__(self, lattice: Lattice):
        self.raw = lattice.raw

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass").replace(MARK, " ").removeprefix(" ")


_loaded: dict[tuple[str, int], tuple[Lattice, Decoder]] = {}


def _get(path: str, n_best: int) -> tuple[Lattice, Decoder]:
    if (path, n_best) not in _loaded:
        lattice = Lattice.load(path, n_best)
        _loaded[path, n_best] = lattice, Decoder(lattice)
    return _loaded[path, n_best]


def encode_pieces(docs: DataFrame, model: str, n_best: int = 5, with_ids: bool = False) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, score, scores (of the n_best), round_trip and, if asked, ids (of the n_best).

    round_trip: the best path's ids, decoded as they leave here, give the normalised text.
    """
    fields = [("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("score", pa.float64()), ("scores", pa.list_(pa.float64())), ("paths_crc32", pa.int64()), ("round_trip", pa.bool_())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.list_(pa.int32())))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, decoder = _get(model, n_best)
        for b in (c for batch in batches for c in chunks(batch)):
            rows, split = [], [split_words(t) for t in b.column("text").to_pylist()]
            lattice.know(split)
            for doc_id, words, (scores, packed, same) in zip(b.column("doc_id").to_pylist(), split, lattice.chains(split), strict=True):
                same = same and decoder.decode(np.frombuffer(packed[0], "<i4").tolist()) == " ".join(words)
                ids = [np.frombuffer(p, "<i4") for p in packed] if with_ids else None
                rows.append((doc_id, len(packed[0]) // 4, zlib.crc32(packed[0]), scores[0], scores, zlib.crc32(b"|".join(packed)), same, ids))
            cols = list(zip(*rows, strict=True))[: len(schema)] or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    kind = "doc_id long, n_pieces long, ids_crc32 long, score double, scores array<double>, paths_crc32 long, round_trip boolean"
    return _store.id_text(docs).mapInArrow(run, kind + (", ids array<array<int>>" if with_ids else ""))


def decode_pieces(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """doc_id and the normalised text of each row's id array; a null array gives a null text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _get(model, 5)
        for b in batches:
            texts = [x if x is None else decoder.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], schema=schema)

    return rows.select("doc_id", ids).mapInArrow(run, "doc_id long, text string")
