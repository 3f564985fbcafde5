"""Token ids in binary files of compressed planes, in ascending order of document ids.

A file holds the ids of a range of documents, cut into blocks of ``BLOCK`` ids.
Each block is transposed into byte (or bit) planes, and each plane compressed
alone; byte planes are the default, as they come out smaller and quicker for
ids of this vocabulary. At the end stand the documents' ids and sizes, then the chunk index:

    magic | planes of block 0 | ... | documents | index | length of index (8 bytes) | magic

A task writes its file under a name of its own attempt and reports it in the
manifest, which Spark commits; a file of a lost or repeated attempt is in no
manifest and is never read.

Null and empty texts hold the end id only. Null document ids come first; rows
that share an id are ordered by the hash of their text. An empty table writes
no file and reads back as no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Scratch, offsets_by_part, text_of
from orderloom.llm.tokens import encoder, slices

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
MANIFEST = "part long, file string, n_docs long, n_ids long, n_bytes long"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Of unsigned little-endian ids: plane k holds bit (or byte) k of each id."""
    raw = ids.view(np.uint8).reshape(len(ids), ids.dtype.itemsize)
    if bits:
        raw = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
        return [x.tobytes() for x in raw]
    return [x.tobytes() for x in raw.T]


def from_planes(planes: list[bytes], n: int, dtype: np.dtype, bits: bool) -> np.ndarray:
    raw = np.stack([np.frombuffer(x, np.uint8) for x in planes])
    if bits:
        raw = np.packbits(np.unpackbits(raw, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
    else:
        raw = np.ascontiguousarray(raw.T)
    return raw.reshape(-1).view(dtype)


class Writer:
    def __init__(self, path: str, dtype: np.dtype, bits: bool, level: int):
        import zstandard

        where, name = filesystem(path)
        self.out, self.at, self.blocks, self.docs = where.open_output_stream(name), 0, [], []
        self.dtype, self.bits, self.squeeze = dtype, bits, zstandard.ZstdCompressor(level=level).compress
        self.waiting, self.n_waiting, self.n_ids = [], 0, 0
        self._put(MAGIC)

    def _put(self, raw: bytes) -> int:
        self.out.write(raw)
        self.at += len(raw)
        return len(raw)

    def _block(self, ids: np.ndarray) -> None:
        at = self.at
        self.blocks.append([at, len(ids), [self._put(self.squeeze(p)) for p in to_planes(ids, self.bits)]])

    def add(self, doc_ids: pa.Array, ids: list[bytes]) -> None:
        size = self.dtype.itemsize
        n = pa.array([len(x) // size for x in ids], pa.int64())
        self.docs.append(pa.RecordBatch.from_arrays([doc_ids, n], names=["id", "n"]))
        self.waiting.append(np.frombuffer(b"".join(ids), self.dtype))
        self.n_waiting += len(self.waiting[-1])
        if self.n_waiting >= BLOCK:
            self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        ids, a = np.concatenate(self.waiting), 0
        while len(ids) - a >= least and a < len(ids):
            self._block(ids[a : a + BLOCK])
            a += BLOCK
        self.n_ids += min(a, len(ids))
        self.waiting, self.n_waiting = [ids[a:].copy()], max(0, len(ids) - a)

    def close(self) -> tuple[int, int, int]:
        if self.n_waiting:
            self._flush(1)
        at, sink = self.at, pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.docs[0].schema) as stream:
            for batch in self.docs:
                stream.write_batch(batch)
        index = {"dtype": self.dtype.str, "bits": self.bits, "docs": [at, self._put(self.squeeze(sink.getvalue().to_pybytes()))], "blocks": self.blocks}
        n = self._put(self.squeeze(json.dumps(index).encode()))
        self._put(n.to_bytes(8, "little") + MAGIC)
        self.out.close()
        return sum(b.num_rows for b in self.docs), self.n_ids, self.at


class Reader:
    """Reads the chunk index, and then only the blocks asked for."""

    def __init__(self, path: str):
        import zstandard

        where, name = filesystem(path)
        self.file, self.open = where.open_input_file(name), zstandard.ZstdDecompressor().decompress
        size, tail = self.file.size(), 8 + len(MAGIC)
        end = self.file.read_at(tail, size - tail)
        if end[8:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token file, or is cut short")
        n = int.from_bytes(end[:8], "little")
        index = json.loads(self.open(self.file.read_at(n, size - tail - n)))
        self.dtype, self.bits, self.blocks = np.dtype(index["dtype"]), index["bits"], index["blocks"]
        at, n = index["docs"]
        self.docs = pa.ipc.open_stream(self.open(self.file.read_at(n, at))).read_all()

    def block(self, k: int) -> np.ndarray:
        at, n, sizes = self.blocks[k]
        raw, planes = self.file.read_at(sum(sizes), at), []
        for size in sizes:
            planes.append(self.open(raw[:size]))
            raw = raw[size:]
        return from_planes(planes, n, self.dtype, self.bits)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first to last, of this file."""
        blocks = [self.block(k) for k in range(first // BLOCK, -(-last // BLOCK))]
        at = first // BLOCK * BLOCK
        return np.concatenate([np.empty(0, self.dtype), *blocks])[first - at : last - at]


def _write(path: str, tokenizer: str, end_id: int | None, bits: bool, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, out = encoder(tokenizer), TaskContext.get(), None
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        name = f"{path}/part-{task.partitionId():05d}-{task.taskAttemptId()}.planes"
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(1)).to_pylist()):
                out = out or Writer(name, enc.dtype, bits, level)
                out.add(batch.column(0).slice(a, b - a), [x + end for x in enc.encode(batch.column(1).slice(a, b - a).to_pylist())])
        if out:
            n_docs, n_ids, n_bytes = out.close()
            yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "file": [name], "n_docs": [n_docs], "n_ids": [n_ids], "n_bytes": [n_bytes]})

    return run


def write(docs: DataFrame, tokenizer: str, end_id: int | None = 2, bits: bool = False, level: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files into a new scratch folder; the manifest, one row per file, in order of ``part``."""
    scratch = Scratch(docs.sparkSession)
    path = f"{scratch.path}/files"
    where, name = filesystem(path)
    where.create_dir(name, recursive=True)
    tie = F.xxhash64("text")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    return scratch.keep(rows.mapInArrow(_write(path, tokenizer, end_id, bits, level), MANIFEST), "manifest")


def _read(base: dict[int, int]):
    def checked(path: str, start: int) -> Iterator[pa.RecordBatch]:
        reader = Reader(path)
        sizes = reader.docs.column("n").to_numpy()
        crcs, at, doc, crc, left = np.zeros(len(sizes), np.int64), 0, 0, 0, int(sizes[0])
        for k in range(len(reader.blocks)):
            ids, at = reader.block(k).astype("<u4"), 0
            while at < len(ids) or doc < len(sizes) and not left:
                n = min(left, len(ids) - at)
                crc, at, left = zlib.crc32(ids[at : at + n], crc), at + n, left - n
                if not left:
                    crcs[doc], doc, crc = crc, doc + 1, 0
                    left = int(sizes[doc]) if doc < len(sizes) else 0
        starts = start + np.cumsum(sizes) - sizes
        ids = reader.docs.column("id").combine_chunks()
        for a in range(0, len(sizes), 10_000):
            b = min(a + 10_000, len(sizes))
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(starts[a:b]), pa.array(sizes[a:b]), pa.array(crcs[a:b])], names=["id", "start", "n_tokens", "ids_crc32"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from checked(path, base[part])

    return run


def read(manifest: DataFrame, id_type: T.DataType) -> DataFrame:
    """Of each document in the files: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    base = offsets_by_part(manifest.select("part", "n_ids"))
    schema = T.StructType([T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))])
    return manifest.select("part", "file").repartition(max(1, len(base))).mapInArrow(_read(base), schema)
