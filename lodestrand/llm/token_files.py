"""Token-id files: patched frame-of-reference blocks.

A file holds the ids of whole documents.  Ids are cut into blocks; a block stores its minimum, the differences from it
packed at the width that a percentile of them needs, and the few wider ones in an exception list.  An index has the
start of every block, so a document's ids are read from the blocks that hold them alone.

Layout (little endian)::

    magic 8s "PFORIDS1" | block_size u32 | n_blocks u32 | n_ids u64 | n_docs u64
    doc valid u8[n_docs] | doc id i64[n_docs] | doc length u64[n_docs]
    block start u64[n_blocks + 1]   (byte offsets from the end of this index)
    block: minimum u32 | width u8 | n_exceptions u32 | packed differences | position u32[] | difference u32[]

Writing: documents are range-partitioned by (doc_id, hash of the text), sorted, encoded and written by the task that
holds them.  Every attempt writes files of its own name and only the manifest, committed by Spark, says which count: a
lost executor or a second attempt leaves nothing but an unlisted file.  Files go through ``pyarrow.fs``.

Defined results: a null text is empty and yields the end id alone; a null doc_id sorts first and is read back null; rows
that repeat a doc_id are separate documents; an empty table gives no file and no row; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
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

_HEAD = struct.Struct("<8sIIQQ")
_BLOCK = struct.Struct("<IBI")
MAGIC = b"PFORIDS1"
#: Ids of a block, percentile that sets the packed width, ids after which a task starts its next file.
BLOCK, PERCENTILE, IDS_A_FILE = 4096, 95.0, 4_000_000
MANIFEST = "part int, seq int, file string, n_docs long, n_ids long, n_bytes long"
READ = "doc_id long, start long, n_tokens long, ids binary"


def pack_block(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(values.min())
    diff = values.astype("<u4") - np.uint32(low)
    width = int(np.percentile(diff, percentile, method="higher")).bit_length()
    wide = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    kept = diff.copy()
    kept[wide] = 0
    raw = kept.view(np.uint8).reshape(-1, 4)
    packed = raw[:, : width // 8] if width % 8 == 0 else np.packbits(np.unpackbits(raw, axis=1, count=width, bitorder="little").ravel(), bitorder="little")
    return b"".join((_BLOCK.pack(low, width, len(wide)), packed.tobytes(), wide.astype("<u4").tobytes(), diff[wide].astype("<u4").tobytes()))


def unpack_block(raw: bytes, n: int) -> np.ndarray:
    low, width, n_wide = _BLOCK.unpack_from(raw)
    size = (n * width + 7) // 8
    packed, whole = np.frombuffer(raw, np.uint8, size, _BLOCK.size), np.zeros((n, 4), np.uint8)
    if width % 8 == 0:
        whole[:, : width // 8] = packed.reshape(n, width // 8)
    else:
        bits = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
        whole[:, : (width + 7) // 8] = np.packbits(bits, axis=1, bitorder="little")
    diff = whole.view("<u4").ravel()
    at = _BLOCK.size + size
    if n_wide:
        diff[np.frombuffer(raw, "<u4", n_wide, at)] = np.frombuffer(raw, "<u4", n_wide, at + 4 * n_wide)
    return diff + np.uint32(low)


def dump(docs: list[tuple[int | None, bytes]], block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """A file's bytes; docs: (doc_id, ids as little-endian unsigned 32-bit integers)."""
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    blocks = [pack_block(ids[i : i + block], percentile) for i in range(0, len(ids), block)]
    return b"".join((
        _HEAD.pack(MAGIC, block, len(blocks), len(ids), len(docs)),
        np.array([d is not None for d, _ in docs], np.uint8).tobytes(),
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([len(x) // 4 for _, x in docs], "<u8").tobytes(),
        np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes(),
        *blocks,
    ))


class IdFile:
    """Random access to a file's documents."""

    def __init__(self, raw: bytes):
        magic, self.block, n_blocks, self.n_ids, n = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        at = _HEAD.size
        valid = np.frombuffer(raw, np.uint8, n, at)
        ids = np.frombuffer(raw, "<i8", n, at := at + n)
        self.lengths = np.frombuffer(raw, "<u8", n, at := at + 8 * n).astype(np.int64)
        self.blocks = np.frombuffer(raw, "<u8", n_blocks + 1, at := at + 8 * n).astype(np.int64)
        self.body, self.raw = at + 8 * (n_blocks + 1), memoryview(raw)
        self.doc_ids = [int(i) if ok else None for ok, i in zip(valid, ids, strict=True)]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def values(self, start: int, end: int) -> np.ndarray:
        """Ids start..end of the file; only the blocks that hold them are unpacked."""
        if end <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        parts = [unpack_block(self.raw[self.body + self.blocks[b] : self.body + self.blocks[b + 1]], min(self.block, self.n_ids - b * self.block)) for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block : end - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.values(int(self.starts[k]), int(self.starts[k] + self.lengths[k]))


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block: int = BLOCK, percentile: float = PERCENTILE, ids_a_file: int = IDS_A_FILE) -> DataFrame:
    """Encode every text, append ``end_id``, write files below ``path`` in ascending doc_id order; returns the manifest."""
    rows = _store.id_text(docs).withColumn("_tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    @lean("tokenizer")
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc, tail = TaskContext.get().partitionId(), encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        held: list[tuple[int | None, bytes]] = []
        size = seq = 0

        def flush() -> pa.RecordBatch:
            store, where = _filesystem(path)
            store.create_dir(where, recursive=True)
            name, raw = f"ids-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.pfor", dump(held, block, percentile)
            with store.open_output_stream(f"{where}/{name}") as out:
                out.write(raw)
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "file": f"{path}/{name}", "n_docs": len(held), "n_ids": size, "n_bytes": len(raw)}], schema=_MANIFEST)

        for b in (c for batch in batches for c in chunks(batch, size=1 << 22)):
            for doc_id, own in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text")), strict=True):
                held.append((doc_id, own + tail))
                size += len(own) // 4 + 1
                if size >= ids_a_file:
                    yield flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    return _store.materialize(dealt.mapInArrow(write, MANIFEST), "id-manifest")


_MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])


def read_ids(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents of the listed files: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if asked, ids.

    The running total is over one row a file, not a document.
    """
    spark = manifest.sparkSession
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = manifest.select("file", before.alias("base")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if with_ids else []))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, base in zip(b.column("file").to_pylist(), b.column("base").to_pylist(), strict=True):
                store, where = _filesystem(uri)
                with store.open_input_file(where) as f:
                    data = IdFile(f.read())
                for lo in range(0, len(data.doc_ids), 4096):
                    hi = min(lo + 4096, len(data.doc_ids))
                    first = int(data.starts[lo])
                    span = data.values(first, int(data.starts[hi - 1] + data.lengths[hi - 1])).astype("<u4").tobytes()
                    cut = [4 * (int(s) - first) for s in data.starts[lo:hi]]
                    own = [span[c : c + 4 * int(n)] for c, n in zip(cut, data.lengths[lo:hi], strict=True)]
                    cols = [pa.array(data.doc_ids[lo:hi], pa.int64()), pa.array(data.starts[lo:hi] + base, pa.int64()), pa.array(data.lengths[lo:hi], pa.int64()), pa.array(map(zlib.crc32, own), pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols + ([pa.array(own, pa.binary())] if with_ids else []), schema=schema)

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
