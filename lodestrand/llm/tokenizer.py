"""Token ids of whole texts by the ``tokenizers`` library, with a bounded memo of the words met.

The word BPE vocabulary drops white space before it merges, so the ids of a text are the ids of its chunks, the stretches between
white space, in order.  A batch is cut into chunks as one Arrow array; its distinct chunks alone are looked at, and the ids of all
its texts are gathered from theirs.  A chunk of letters and ASCII punctuation after them is a word in lower case and its tail.
Ids are kept as packed little-endian unsigned 32-bit integers.

New words that are letters alone are encoded many at a time, in lower case: such a word is one pre-token, whose last id,
and only that, ends with the model's end-of-word suffix.  They need no normalizing and no splitting but at spaces, so that a copy of
the tokenizer without either encodes them where its parts are known.  All other chunks are encoded one by one.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import _workers

#: A worker's memo is emptied beyond this many words and other chunks (about 130 MB); results never depend on it.
MEMO = 600_000
_PUNCT = ".,!#$%&*|:;-\"'"
#: Letters that no Unicode normal form and no neighbour changes.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SEPARATORS = " \n\t\r"
_SEPARATES = np.isin(np.arange(256), [ord(c) for c in _SEPARATORS])
_RUN = 4096
#: The splitting of which a word of letters alone is one piece.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_open: dict[str, ChunkEncoder] = {}


class ChunkEncoder:
    """Encodes texts for a tokenizer whose pre-tokenizer drops white space (word_bpe_49k.json is one)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A chunk that can hold an added token's text is never split further.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(w in c for c in self.added for w in " \t\n\r"):
            raise ValueError("an added token holds white space: chunks cannot be encoded alone")
        self.memo: dict[str, bytes] = {"": b""}
        self.limit = MEMO
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix and all(self._ids(c) == self._ids(c.lower()) for c in map(chr, range(65, 256)) if _LETTERS.fullmatch(c)):
            self.closes[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self.plain = self._plain(path)

    def _plain(self, path: str):
        """A tokenizer for lower-case words of letters with spaces between them; the whole one if its parts are others."""
        from tokenizers import Tokenizer, pre_tokenizers

        parts = (json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}).get("pretokenizers", [])
        split = [(p["type"], p.get("pattern"), p.get("behavior"), p.get("invert"), p.get("add_prefix_space"), p.get("use_regex")) for p in parts]
        if split != [("Split", {"Regex": _SPLIT}, "Removed", True, None, None), ("ByteLevel", None, None, None, False, False)]:
            return self.tokenizer
        plain = Tokenizer.from_file(path)
        plain.normalizer = None
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return plain

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _words(self, words: list[str]) -> None:
        """Lower-case words of letters, encoded as texts of many words."""
        memo, odd = self.memo, []
        for i in range(0, len(words), _RUN):
            own = words[i : i + _RUN]
            ids = np.array(self.plain.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.closes[np.minimum(ids, len(self.closes) - 1)]) + 1
            if len(ends) == len(own):
                flat, cuts = ids.tobytes(), (4 * ends).tolist()
                memo.update(zip(own, [flat[a:b] for a, b in zip([0, *cuts], cuts, strict=False)], strict=True))
            else:
                odd += own
        self._chunks(odd)

    def _chunks(self, chunks: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)] if chunks else []
        flat = np.fromiter(chain.from_iterable(ids), dtype="<u4").tobytes()
        at, memo = 0, self.memo
        for chunk, own in zip(chunks, ids, strict=True):
            memo[chunk] = flat[at : (at := at + 4 * len(own))]

    def _learn(self, keys: list[str], plain: list[bool]) -> list[bytes]:
        """The ids of every key; plain: whether it is a lower-case word of letters."""
        memo = self.memo
        got = list(map(memo.get, keys))
        missing = [i for i, ids in enumerate(got) if ids is None]
        if len(memo) + len(missing) > min(self.limit, MEMO):
            memo.clear()
            memo[""] = b""
            missing = [i for i, k in enumerate(keys) if k]
        # A stem that ends in a letter and the ASCII punctuation after it are separate pre-tokens.
        parts, words, chunks = [], [], set()
        for i in missing:
            c = keys[i]
            if plain[i]:
                words.append(c)
                continue
            stem = c.rstrip(_PUNCT)
            tail = c[len(stem) :]
            if stem and tail and stem[-1].isalpha() and not any(x in c for x in self.added):
                parts.append((c, stem, tail))
                chunks.update((stem, tail))
            else:
                chunks.add(c)
        self._words(words)
        self._chunks(list(chunks.difference(memo)))
        for c, stem, tail in parts:
            memo[c] = memo[stem] + memo[tail]
        for i in missing:
            got[i] = memo[keys[i]]
        return got

    def _distinct(self, chunks: pa.Array) -> pa.Array:
        """The ids of distinct chunks."""
        whole = pc.ascii_rtrim(chunks, _SEPARATORS)
        stems = pc.ascii_rtrim(whole, _PUNCT)
        plain = pc.match_substring_regex(stems, f"^{_LETTERS.pattern}$") if self.closes.any() else pa.array(np.zeros(len(chunks), bool))
        # The tail of a plain chunk is what follows its stem; any other chunk is a key as a whole.
        is_plain, size = plain.to_numpy(zero_copy_only=False), pc.binary_length(whole).to_numpy().astype(np.int64)
        tails = np.where(is_plain, size - pc.binary_length(stems).to_numpy(), 0)
        ends = np.cumsum(size)
        cuts = np.concatenate(([0], np.cumsum(tails)))
        at = np.repeat(ends - cuts[1:], tails) + np.arange(cuts[-1])
        raw = _bytes(whole)[at]
        keys = pa.concat_arrays([pc.if_else(plain, pc.utf8_lower(stems), whole).cast(pa.large_string()), _strings(cuts, raw)]).dictionary_encode()
        place = keys.indices.to_numpy()
        letters = np.zeros(len(keys.dictionary), bool)
        letters[place[: len(chunks)][is_plain]] = True
        ids = pa.array(self._learn(keys.dictionary.to_pylist(), letters.tolist()), pa.large_binary())
        return pc.binary_join_element_wise(ids.take(keys.indices[: len(chunks)]), ids.take(keys.indices[len(chunks) :]), pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: Iterable[str] | pa.Array) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not len(texts):
            return []
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        at = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy())))
        data = _bytes(texts)
        # A chunk ends with the separator after it, so that chunks lie one after another.
        opens = np.zeros(len(data) + 1, bool)
        opens[1:] = _SEPARATES[data]
        opens[at] = True
        cuts = np.flatnonzero(opens)
        chunks = _strings(cuts, data).dictionary_encode()
        if not len(chunks):
            return [b""] * len(texts)
        ids = self._distinct(chunks.dictionary).take(chunks.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1][np.searchsorted(cuts, at)].tolist()
        flat = memoryview(ids.buffers()[2] or b"")
        return [bytes(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _bytes(texts: pa.Array) -> np.ndarray:
    """The bytes of an array of strings without nulls, one text after another."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else [0, 0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)


def _strings(cuts: np.ndarray, data: np.ndarray) -> pa.Array:
    """The strings between the cuts."""
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def encoder(path: str, limit: int | None = None) -> ChunkEncoder:
    """One encoder a worker process, its memo bounded by ``limit`` from now on; gone when another operator takes the worker."""
    if path not in _open:
        _open[path] = ChunkEncoder(path)
    _open[path].limit = limit or MEMO
    _workers.hold("tokenizer", _open.clear)
    return _open[path]
