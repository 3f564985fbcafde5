"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two that differ in at most d bits
share at least 8 - d of them, so the tally of shared positional bytes of a pair
must reach 8 - d. Posting lists of single bytes would be as long as the table
divided by 256. The index therefore posts each distinct fingerprint under every
choice of 8 - d positions with their bytes: fingerprints meet under a key just
if their tally reaches the minimum. Pairs are counted under the first such key
only, then verified by their differing bits.

Under one key fingerprints differ in d bytes alone, so a list holds at most
2 ** (8 d) of them. Long lists are not paired off: each fingerprint looks up
its neighbours by flipping up to d of the free bits, and a list passes on a
spanning forest of its links. Exact copies fold into one fingerprint first.

Null and empty texts have the fingerprint zero, which links like any other.
Rows that share an id and text get equal rows. A component is named by its
smallest id; null ids count only if there is no other. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Scratch, free
from orderloom.llm.components import components, forest
from orderloom.llm.tokens import slices

SEED = 42
BYTES = 8
#: Column of the fingerprint beside those of the documents.
FP = "__fp"
#: Lists up to this length are compared pair by pair.
SHORT = 64


def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - k + 1]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)])
    rows, ones = np.frombuffer(hashes, np.uint8).reshape(-1, BYTES), np.zeros(64, np.int64)
    for a in range(0, len(rows), 1 << 14):
        ones += np.unpackbits(rows[a : a + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(pc.binary_length(whole.column(1)).fill_null(0).to_pylist(), 16 << 20):
                batch = whole.slice(a, b - a)
                found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (64 bits, signed) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_fingerprints(shingle), schema)


def masks(max_bits: int) -> list[int]:
    """One for every choice of the positions that two fingerprints must share."""
    return [sum(0xFF << 8 * p for p in some) for some in combinations(range(BYTES), BYTES - max_bits)]


def _close(fps: np.ndarray, mask: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in ``fps``, ascending) that differ in at most ``max_bits`` bits."""
    if len(fps) <= SHORT:
        a, b = np.triu_indices(len(fps), 1)
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        return a[near], b[near]
    free = [1 << i for i in range(64) if not mask >> i & 1]
    found = []
    for k in range(1, max_bits + 1):
        for bits in combinations(free, k):
            other = fps ^ np.uint64(sum(bits))
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = np.flatnonzero((fps[at] == other) & (at > np.arange(len(fps))))
            found.append((hit, at[hit]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _links(max_bits: int):
    choices = masks(max_bits)

    def of_list(choice: int, fps: np.ndarray) -> np.ndarray:
        fps = np.unique(fps.view(np.uint64))
        a, b = _close(fps, choices[choice], max_bits)
        shared = ((fps[a] ^ fps[b]).view(np.uint8).reshape(-1, BYTES)) == 0
        # The first choice of positions, all shared, is the one that counts the pair.
        tally = shared.cumsum(axis=1)
        first = shared & (tally <= BYTES - max_bits)
        held = (first * (np.uint64(0xFF) << np.uint64(8) * np.arange(BYTES, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
        mine = (tally[:, -1] >= BYTES - max_bits) & (held == np.uint64(choices[choice]))
        root = forest(len(fps), a[mine], b[mine])
        child = np.flatnonzero(root != np.arange(len(fps)))
        return np.stack([fps[child], fps[root[child]]]).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the list that may go on in the next batch
        for batch in chain(batches, (None,)):
            if batch is None:
                rows = held
            else:
                rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
                rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if rows is None or not rows.shape[1]:
                continue
            cuts = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
            edges = np.concatenate([[0], cuts, [rows.shape[1]]])
            held = rows[:, edges[-2] :]
            last = len(edges) - 1 if batch is None else len(edges) - 2
            long = np.flatnonzero(np.diff(edges)[:last] > 1)
            found = [of_list(int(rows[0, edges[k]]), rows[2, edges[k] : edges[k + 1]]) for k in long]
            found = np.concatenate([np.empty((2, 0), np.int64), *found], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    return run


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """A spanning set of the links (a, b) between distinct fingerprints ``fp``."""
    if not 0 < max_bits < BYTES:
        raise ValueError(f"the index needs 1 to {BYTES - 1} differing bits")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(max_bits)]
    keys = F.array(*(F.struct(F.lit(i).cast("long").alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(signed)))
    posted = distinct.select("fp", F.explode(keys).alias("at")).select("at.choice", "at.key", "fp")
    return posted.repartition("choice", "key").sortWithinPartitions("choice", "key").mapInArrow(_links(max_bits), "a long, b long")


def _rooted(distinct: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """``distinct``, one row per fingerprint ``fp``, with the ``root`` of its component."""
    linked = components(scratch.keep(links(distinct.select("fp"), max_bits), "links"), scratch)
    return distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp")).drop("component")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp and component_id of every row."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = scratch.keep(found.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    rooted = _rooted(distinct, max_bits, scratch)
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id")
    return found.join(named, "fp").select("id", "fp", "component_id")


def _with_fingerprints(shingle: int, place: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(pc.binary_length(whole.column(place)).fill_null(0).to_pylist(), 16 << 20):
                batch = whole.slice(a, b - a)
                found = np.array([fingerprint(t, shingle) for t in batch.column(place).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *batch.columns], names=[name, *batch.schema.names])

    return run


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document of the smallest id of each component, null ids last. Of its rows that share that id, the one whose text sorts first."""
    scratch = Scratch(docs.sparkSession)
    name = free(FP, docs.columns)
    schema = T.StructType([T.StructField(name, T.LongType()), *docs.schema.fields])
    rows = docs.mapInArrow(_with_fingerprints(shingle, docs.columns.index(text_col), name), schema)

    def first(row: str) -> Column:
        i = F.col(row)[id_col]
        return F.min_by(row, F.struct(i.isNull(), i, F.coalesce(F.col(row)[text_col], F.lit("")))).alias("row")

    whole = rows.select(F.col(name).alias("fp"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    distinct = scratch.keep(whole.groupBy("fp").agg(first("row")), "distinct")
    return _rooted(distinct, max_bits, scratch).groupBy("root").agg(first("row")).select("row.*")
