"""Documents drawn in proportion to how much more a target text looks like them than the corpus does.

1. Features are runs of one to two words, hashed into buckets. The buckets of
   all documents and of all target texts are counted; a bucket's gain is the
   logarithm of its share in the target over its share in the corpus.
2. The gains are an array of one number a bucket. A document's weight is the
   mean over its features; a draw by its id is added (the Gumbel trick), so that
   the highest scores are a sample without replacement by the weights.
3. *Distributed quickselect* finds the last score drawn. Random keys of the rows
   in question are pivots; one pass counts exactly how many rows come before,
   at and after each; the rows between two pivots are the next ones in question.
   The key is the score, then the id, then the row, so no two are equal.
4. Only the drawn rows are sorted, by ranges, and ranked.

Words are runs of letters a-z (A-Z in lower case), digits and all beyond ASCII.
A null text has none. A null id counts as empty in the draw and comes after all
ids; rows that share an id share the draw and may both be taken. Empty tables
give no rows; without a target every bucket's share in it is the same. A text is
one value in a task, where its words are held at once, so it should stay below
some hundred MB.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Scratch, offsets_by_part
from orderloom.llm.tokens import slices

BUCKETS = 10_000
PIVOTS = 32
RANKED_IN_ONE_TASK = 1 << 20
#: Bytes of a word, A-Z in lower case; all others part words.
WORD_BYTES = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def features(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all words and of all pairs of neighbours."""
    words = text.translate(WORD_BYTES).split()
    one = [crc32(w) for w in words]
    two = [crc32(w, crc32(b" ", before)) for w, before in zip(words[1:], one)]
    return len(words), np.array(one + two, np.int64) % buckets


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for a, b in slices(pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), 4 << 20):
        some = batch.slice(a, b - a)
        yield some, [t or b"" for t in some.column(column).to_pylist()]


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _texts(batch, 0):
                total += np.bincount(np.concatenate([features(t, buckets)[1] for t in texts]), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    found = texts.select(F.col(text_col).cast("binary")).mapInArrow(_count(buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket at most
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the logarithm of target share over corpus share of each bucket, one added to each count, rounded down."""
    buckets, in_corpus, in_target = len(corpus), int(corpus.sum()), int(target.sum())
    share = lambda s, t: float(t + 1) * float(in_corpus + buckets) / (float(s + 1) * float(in_target + buckets))
    return np.array([math.floor(1000 * math.log(share(s, t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def draw(doc_id: str, seed: int) -> int:
    """A Gumbel number in thousandths, the same for one id whenever it is asked for."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))


def _score(gain: np.ndarray, seed: int):
    def one(text: bytes, doc_id: str | None) -> tuple[int, int, int, int]:
        words, found = features(text, len(gain))
        weight = int(gain[found].sum()) // len(found) if len(found) else 0
        return words, len(found), weight, weight + draw(doc_id or "", seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, texts in _texts(batch, 2):
                columns = zip(*map(one, texts, some.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=["id", "n_words", "n_features", "weight", "score"])

    return run


def _key() -> list[Column]:
    return [(-F.col("score")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("c"), F.col("row").alias("d")]


def kth(rows: DataFrame, k: int, scratch: Scratch, seed: int, pivots: int = PIVOTS):
    """The ``k``-th smallest of the unique keys of ``rows`` (columns a to d); they must be at least ``k``, and ``k`` at least 1."""
    kind = rows.schema["c"].dataType
    value = lambda p: F.struct(F.lit(p.a).alias("a"), F.lit(p.b).alias("b"), F.lit(p.c).cast(kind).alias("c"), F.lit(p.d).alias("d"))
    key, turn = F.struct("a", "b", "c", "d"), 0
    while True:
        drawn = rows.orderBy(F.xxhash64("d", F.lit(seed + turn))).limit(pivots)
        chosen = drawn.orderBy("a", "b", F.col("c").asc_nulls_first(), "d").collect()
        before = rows.agg(*[F.count_if(key < value(p)).alias(f"n{i}") for i, p in enumerate(chosen)]).first()
        after = bisect_left(list(before), k)  # the first pivot with k or more rows before it
        if after and before[after - 1] == k - 1:
            return chosen[after - 1]
        if after:
            k -= before[after - 1] + 1
            rows = rows.where(key > value(chosen[after - 1]))
        if after < len(chosen):
            rows = rows.where(key < value(chosen[after]))
        rows, turn = scratch.keep(rows, f"asked{turn}"), turn + 1
        if turn > 1:
            scratch.remove(f"asked{turn - 2}")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = BUCKETS,
) -> DataFrame:
    """id, n_words, n_features, weight, score and rank of every row; rows that were not drawn have no rank."""
    scratch = Scratch(docs.sparkSession)
    gain = gains(counts(docs, text_col, buckets), counts(target, target_col, buckets))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("named"), F.col(text_col).cast("binary").alias("text"))
    scored = rows.mapInArrow(_score(gain, seed), f"id {kind}, n_words long, n_features long, weight long, score long")
    scored = scratch.keep(scored.withColumn("row", F.monotonically_increasing_id()), "scored")

    wanted = scored.where(F.col("n_words") >= least_words).count() * percent // 100
    shown = ["id", "n_words", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*shown, F.lit(None).cast("long").alias("rank"))
    last = kth(scored.where(F.col("n_words") >= least_words).select(*_key()), wanted, scratch, seed)
    limit = F.struct(F.lit(last.a).alias("a"), F.lit(last.b).alias("b"), F.lit(last.c).cast(kind).alias("c"), F.lit(last.d).alias("d"))
    drawn = (F.col("n_words") >= least_words) & (F.struct(*_key()) <= limit)

    by = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    ranged = scored.where(drawn).repartitionByRange(-(-wanted // RANKED_IN_ONE_TASK), *by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = scratch.keep(ranged.select(*shown, F.spark_partition_id().alias("part"), place.alias("place")), "drawn")
    upto = offsets_by_part(ranged.groupBy("part").agg(F.count("*")))
    offsets = docs.sparkSession.createDataFrame(list(upto.items()), "part int, upto long")  # one row a task
    ranked = ranged.join(offsets, "part").select(*shown, (F.col("upto") + F.col("place") + 1).alias("rank"))
    return ranked.unionByName(scored.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank")))
