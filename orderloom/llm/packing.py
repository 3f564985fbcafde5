"""Packing by concatenate and cut.

Pass one encodes every text once and stores the ids; each task keeps a running
sum of its ids and so knows, for each document, how many stand before it in
that task. The sums of the tasks, added up in order, give each task's global
offset. Pass two cuts the documents at multiples of the window. A window that
lies inside one document is whole at once; the others are boundary records,
joined by their sequence number.

Null and empty texts hold the end id only. Repeated rows are packed once each.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Scratch, offsets_by_part, text_of
from orderloom.llm.tokens import encoder, slices

WINDOW = 2048


def _encode(tokenizer: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(1)).to_pylist()):
                some = batch.slice(a, b - a)
                ids = [x + end for x in enc.encode(some.column(1).to_pylist())]
                n = np.array([len(x) for x in ids], np.int64) // enc.dtype.itemsize
                at = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.full(len(n), part)), pa.array(at), pa.array(n), pa.array(ids, pa.binary())],
                    names=["id", "part", "before", "n", "ids"],
                )

    return run


def _cut(base: dict[int, int], window: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, before, ids = (batch.column(i).to_pylist() for i in (1, 2, 4))
            rows, starts, lengths, totals, sequences, offsets, pieces = [], [], [], [], [], [], []
            for row, (p, at, raw) in enumerate(zip(part, before, ids, strict=True)):
                own = np.frombuffer(raw, f"<u{width}").astype("<u4")
                here, start = base[p] + at, 0
                while start < len(own):
                    sequence, offset = divmod(here + start, window)
                    length = min(window - offset, len(own) - start)
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    totals.append(len(own))
                    sequences.append(sequence)
                    offsets.append(offset)
                    pieces.append(own[start : start + length].tobytes())
                    start += length
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, totals, sequences, offsets)), pa.array(pieces, pa.binary())],
                names=["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int | None = 1, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32 bits)."""
    scratch = Scratch(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(c, T.LongType()) for c in ("part", "before", "n")), T.StructField("ids", T.BinaryType())])
    encoded = scratch.keep(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(_encode(tokenizer, end_id), schema), "ids")
    base = offsets_by_part(encoded.groupBy("part").agg(F.sum("n")))
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")), T.StructField("ids", T.BinaryType())])
    return encoded.mapInArrow(_cut(base, window, encoder(tokenizer).dtype.itemsize), schema)


def sequences(found: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence, padded to the window unless it is a power of two long.

    Only windows with a piece of a document's edge are gathered; the rest pass as they are.
    """
    whole = found.where(F.col("length") == window).select("sequence_id", "ids")
    edges = (
        found.where(F.col("length") < window)
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids"))
    )
    n = (F.octet_length("ids") / 4).cast("int")
    missing = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(window - n)
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), missing))
    return whole.unionByName(edges).select("sequence_id", n.cast("long").alias("n_tokens"), F.concat("ids", pad).alias("ids"))
