"""What each of several filters removes in every order they could be applied in.

1. Every document fails some of the filters; the set of them is its mask.
   Documents are counted by part and mask, and nothing larger leaves the tasks:
   2**n cells for a part and n filters, whatever the number of documents.
2. *Gray-code subset walk.* The 2**n sets of filters are visited so that each
   step turns one filter on or off. Every cell carries a counter of the active
   filters it fails; the cells whose counter leaves or reaches 0 are taken from
   or given back to the running survivors. The survivors of every set are kept.
3. What a filter removes at its step of an order is the difference between the
   survivors of two sets. All n! orders are read off the 2**n states.

Words are runs without ASCII white space, as they are written. A null text is
empty. The filters of ``failures``: A, too few words; B, too few of them
different; C, too many of A-Z; D, symbols; E, the same text under a smaller id.
A null id counts as larger than all ids; rows that share the smallest id pass E
together, as neither is smaller. A null part is the empty one. Rows of
``labels`` with one id count once, as good or toxic if any of them says so; a
null id has no label. Empty tables give no rows. A text is one value in a task,
where its words are held at once, so it should stay below some hundred MB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tokens import slices

FILTERS = "ABCDE"
UPPER, SYMBOLS = bytes(range(ord("A"), ord("Z") + 1)), b"#$%&*|"
#: The bytes of UTF-8 that start no code point.
INNER = bytes(range(0x80, 0xC0))


def judge(text: bytes, least_words: int = 100, least_distinct: int = 80, most_upper: int = 10) -> int:
    """Mask of the filters A to D that the text fails; limits but the first are in percent."""
    words = text.split()
    fails = (
        len(words) < least_words,
        100 * len(set(words)) < least_distinct * len(words),
        100 * (len(text) - len(text.translate(None, UPPER))) > most_upper * len(text.translate(None, INNER)),
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(pc.binary_length(batch.column(2)).fill_null(0).to_pylist(), 16 << 20):
            some = batch.slice(a, b - a)
            texts = [t or b"" for t in some.column(2).to_pylist()]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(map(judge, texts), pa.int32()), digests], names=["id", "part", "mask", "digest"])


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """id, part and mask of every row; bit i stands for the filter ``FILTERS[i]``."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("binary").alias("text"))
    judged = rows.mapInArrow(_judged, f"id {kind}, part string, mask int, digest binary")
    first = judged.groupBy(F.col("digest").alias("of"), F.lit(True).alias("is_first")).agg(F.min("id").alias("first"))
    # By text and id: the many rows of one text have as many keys.
    both = judged.join(first, (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")), "left")
    again = F.when(F.col("is_first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return both.select("id", "part", F.col("mask").bitwiseOR(again).alias("mask"))


def survivors(cells: np.ndarray) -> np.ndarray:
    """Of the counts of every mask, those that no filter of a set takes, for every set."""
    n = len(cells)
    masks, failed, out = np.arange(n), np.zeros(n, np.int64), np.empty_like(cells)
    state, left = 0, cells.sum(axis=0)
    out[0] = left
    for i in range(1, n):
        toggled = i & -i  # the bit in which neighbours of the Gray code differ
        state ^= toggled
        on = bool(state & toggled)
        mine = (masks & toggled) != 0
        failed[mine] += 1 if on else -1
        moved = cells[mine & (failed == on)].sum(axis=0)  # failed its first active filter, or no longer any
        left = left - moved if on else left + moved
        out[state] = left
    return out


def orders(cells: np.ndarray, filters: str) -> Iterator[tuple]:
    """Order, step and figures of every order of the filters; ``cells``: documents, good and toxic ones of every mask."""
    left, everything = survivors(cells), len(cells) - 1
    every = list(permutations(range(len(filters))))
    shapley = [0] * len(filters)
    found = []
    for order in every:
        state = 0
        for step, f in enumerate(order, start=1):
            before, state = left[state], state | 1 << f
            removed, good, toxic = (before - left[state]).tolist()
            shapley[f] += removed
            fails = int(left[0][0] - left[1 << f][0])
            alone = int(left[everything ^ 1 << f][0] - left[everything][0])
            found.append((f, "".join(filters[i] for i in order), step, int(left[state][0]), removed, fails - removed, alone, good, toxic))
    for f, *figures in found:
        yield *figures, shapley[f]


REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _walk(filters: str):
    names, kinds = zip(*(c.split() for c in REPORT.split(", ")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                cells = np.zeros((1 << len(filters), 3), np.int64)
                for cell in found:
                    cells[cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
                rows = [(part, *row) for row in orders(cells, filters)]
                arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
                yield pa.RecordBatch.from_arrays([pa.array(c, arrow[k]) for c, k in zip(zip(*rows), kinds, strict=True)], names=list(names))

    return run


def interactions(judged: DataFrame, labels: DataFrame, filters: str = FILTERS, label_id: str = "doc_id") -> DataFrame:
    """``REPORT`` for rows of id, part and mask: a row for every part, order of the filters and step."""
    said = labels.select(F.col(label_id).alias("of"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    said = said.where(F.col("of").isNotNull()).groupBy("of").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    counted = judged.join(said, F.col("id") == F.col("of"), "left").groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return parts.mapInArrow(_walk(filters), REPORT)
