"""Repeated lines dropped from documents, found by two Bloom filters.

1. One scan of the texts takes the first 16 bytes of the SHA-256 of every line's
   key, once for each document (24 bytes a line, no text). The first 8 are its
   hash, which deals it to a shard.
2. Each task passes the distinct hashes of a batch on, marked if the batch had
   them more than once. A shard runs them through two Bloom filters: one of
   hashes seen, one of hashes seen again. The second has every repeated hash, and
   few others. It is folded in half for as long as it stays sparse.
3. The lines meet the second filter of their shard. A task reads the filter
   first and the shard's lines after it, as a stream; a shard of more lines than
   ``most_lines`` is dealt to several tasks, each with a copy of the filter. No
   filter is broadcast.
4. Only suspected repeats are shuffled again, for the exact count of their
   documents and the choice of the one that keeps them.

A line's key is the line without ASCII white space at its ends, A-Z in lower
case. Null and empty texts are one empty line. Rows that share a document id
count as one document; a null id counts as one document below all others. An
empty table gives no rows. Other columns pass unchanged. A text is one value in
a task, where its lines are held at once, so it should stay below some hundred
MB.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Scratch, free
from orderloom.llm.tokens import slices

SPACE = " \t\n\x0b\x0c\r"
PROBES = 4
BITS_PER_HASH = 16
#: Several shards to a task, so that hashing their numbers spreads them evenly.
HASHES_PER_SHARD, HASHES_PER_TASK = 1 << 17, 1 << 20


def keys(text: str | None, least: int) -> set[bytes]:
    """The distinct keys of a text's lines of at least ``least`` code points."""
    stripped = (line.strip(SPACE) for line in (text or "").split("\n"))
    return {k.encode().lower() for k in stripped if len(k) >= least}


def digest(key: bytes) -> bytes:
    """The first 16 bytes of the SHA-256: the hash that deals the line, and the rest."""
    return hashlib.sha256(key).digest()[:16]


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard among the rows, and the places of its rows."""
    order = np.argsort(shard, kind="stable")
    found, starts = np.unique(shard[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, starts[1:]), strict=True) if len(order) else ()


class Bloom:
    """A filter of 2**log_bits bits over 64-bit hashes."""

    def __init__(self, log_bits: int, bits: np.ndarray | None = None):
        self.log_bits = log_bits
        self.bits = np.zeros(1 << (log_bits - 3), np.uint8) if bits is None else bits

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return (hashes + np.arange(PROBES, dtype=np.uint64)[:, None] * step) & np.uint64((1 << self.log_bits) - 1)

    def add(self, hashes: np.ndarray) -> None:
        at = self._places(hashes).ravel()
        np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self._places(hashes)
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)

    def folded(self, most_full: float = 0.2) -> Bloom:
        out = self
        while out.log_bits > 10:
            half = out.bits[: len(out.bits) // 2] | out.bits[len(out.bits) // 2 :]
            if np.bitwise_count(half).sum() > most_full * 8 * len(half):
                break
            out = Bloom(out.log_bits - 1, half)
        return out


def _lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), 4 << 20):
                found = [b"".join(map(digest, keys(text, least))) for text in batch.column(1).slice(a, b - a).to_pylist()]
                row = np.repeat(np.arange(a, b), [len(x) // 16 for x in found])
                both = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["id", "hash", "rest"])

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, times = np.unique(batch.column(0).to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(times > 1)], names=["hash", "again"])


def _filters(shards: int, log_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, Bloom] = {}
        twice: dict[int, Bloom] = {}
        for batch in batches:
            for s, mine in by_shard(batch.column(2).to_numpy()):
                hashes, where = np.unique(batch.column(0).to_numpy()[mine].view(np.uint64), return_inverse=True)
                times = np.bincount(where, weights=1 + batch.column(1).to_numpy(zero_copy_only=False)[mine])
                one, two = (x.setdefault(s, Bloom(log_bits)) for x in (once, twice))
                two.add(hashes[one.has(hashes) | (times > 1)])
                one.add(hashes)
        for s, two in twice.items():
            out = two.folded()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([out.log_bits], pa.int64()), pa.array([out.bits.tobytes()], pa.binary())], names=["shard", "log_bits", "bits"])

    return run


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of each shard and part, the filter first, the lines that the filter holds."""
    at, second = None, None
    for batch in batches:
        shard, part, filled = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).is_valid().to_numpy(zero_copy_only=False)
        change = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (part[1:] != part[:-1])])[: len(shard)])
        for a, b in zip(change.tolist(), [*change[1:].tolist(), len(shard)], strict=True):
            if (here := (shard[a], part[a])) != at:
                at, second = here, None
            if filled[a]:
                second = Bloom(batch.column(2)[a].as_py(), np.frombuffer(batch.column(3)[a].as_py(), np.uint8))
                a += 1
            if second is not None and a < b:
                mine = batch.slice(a, b - a)
                yield mine.select(["id", "hash", "rest"]).filter(pa.array(second.has(mine.column("hash").to_numpy().view(np.uint64))))


def _rewrite(text_at: int, drop_at: int, least: int, counts: tuple[str, str]):
    def one(text: str | None, drop: list[dict] | None) -> tuple[str, int, int]:
        lines = (text or "").split("\n")
        if not drop:
            return text or "", len(lines), 0
        gone = {struct.pack("<qq", d["hash"], d["rest"]) for d in drop}

        def stays(line: str) -> bool:
            key = line.strip(SPACE)
            return len(key) < least or digest(key.encode().lower()) not in gone

        kept = [line for line in lines if stays(line)]
        return "\n".join(kept), len(lines), len(lines) - len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(pc.binary_length(whole.column(text_at)).fill_null(0).to_pylist(), 16 << 20):
                batch = whole.slice(a, b - a)
                texts, lines, dropped = zip(*map(one, batch.column(text_at).to_pylist(), batch.column(drop_at).to_pylist()), strict=True)
                columns = [c for i, c in enumerate(batch.columns) if i != drop_at]
                columns[text_at] = pa.array(texts, pa.string())
                names = [n for i, n in enumerate(batch.schema.names) if i != drop_at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, *counts])

    return run


#: Columns the result has besides those of the documents; where these have them already, ``free`` gives their names.
LINES, DROPPED = "__n_lines", "__n_dropped"


def drop_repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", most_lines: int = HASHES_PER_TASK) -> DataFrame:
    """The documents, with lines whose key of ``least_chars`` or more stands in ``least_docs`` or more
    documents left in the document of the largest id alone; and the counts of lines and of dropped lines.
    """
    scratch = Scratch(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    line = T.StructType([T.StructField("id", kind), T.StructField("hash", T.LongType()), T.StructField("rest", T.LongType())])
    lines = scratch.keep(texts.mapInArrow(_lines(least_chars), line), "lines")
    n = lines.count()
    shards, tasks = -(-n // HASHES_PER_SHARD) or 1, -(-n // HASHES_PER_TASK) or 1
    log_bits = max(13, int(np.ceil(np.log2(max(1, n / shards) * BITS_PER_HASH))))
    shard = F.pmod("hash", F.lit(shards).cast("long")).alias("shard")
    dealt = lines.select("hash").mapInArrow(_hashes, "hash long, again boolean").select("hash", "again", shard).repartition(tasks, "shard")
    filters = scratch.keep(dealt.mapInArrow(_filters(shards, log_bits), "shard long, log_bits long, bits binary"), "filters")
    suspects = scratch.keep(_met(lines.select("*", shard), filters, tasks, most_lines).mapInArrow(_suspects, line), "suspects")

    in_docs = suspects.groupBy("hash", "rest", "id").agg(F.lit(1).alias("one"))
    repeated = scratch.keep(in_docs.groupBy("hash", "rest").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= least_docs), "repeated")
    drops = suspects.join(repeated, ["hash", "rest"]).where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id").agg(F.collect_set(F.struct("hash", "rest")).alias("drop"))

    drop, counts = free("__drop", docs.columns), (free(LINES, docs.columns), free(DROPPED, docs.columns))
    both = docs.alias("d").join(drops.alias("x"), F.col(f"d.{id_col}").eqNullSafe(F.col("x.id")), "left").select("d.*", F.col("x.drop").alias(drop))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema.fields), *(T.StructField(c, T.LongType()) for c in counts)])
    return both.mapInArrow(_rewrite(docs.columns.index(text_col), len(docs.columns), least_chars, counts), schema)


def _met(lines: DataFrame, filters: DataFrame, tasks: int, most_lines: int) -> DataFrame:
    """Lines and filters dealt by shard, a large shard in parts of ``most_lines``; each part has its filter before its lines."""
    large = lines.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > most_lines).select("shard", F.ceil(F.col("n") / most_lines).alias("parts"))
    spread = F.pmod(F.xxhash64("id", "rest"), F.coalesce("parts", F.lit(1).cast("long")))
    rows = lines.join(large, "shard", "left").select("shard", spread.alias("part"), F.lit(None).cast("long").alias("log_bits"), F.lit(None).cast("binary").alias("bits"), "id", "hash", "rest")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1))
    none = [F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in ("id", "hash", "rest")]
    copies = filters.join(large, "shard", "left").select("shard", every.alias("part"), "log_bits", "bits", *none)
    return copies.unionByName(rows).repartition(tasks, "shard", "part").sortWithinPartitions("shard", "part", F.col("log_bits").asc_nulls_last())
