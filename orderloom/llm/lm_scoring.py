"""Language-model scoring of whole texts: prediction by partial matching, beside a base of single tokens.

Both read the text with A-Z in lower case.

**The model** is a byte-context trie, trained before scoring. A byte is
predicted from the ``DEPTH`` before it; one not seen there escapes to the
context that is one shorter, down to none and then to all 257 symbols alike
(256 bytes and the edge, which ends a text and stands before it). Escapes are
estimated by method C: with T occurrences of q distinct symbols a context gives
q / (T + q) to escape. Symbols of longer contexts are excluded in shorter ones.
As training ends before scoring, the code length of a symbol in a context is a
constant, worked out once.

**The base** sums log10((c + 0.5) / (N + 0.5 (V + 1))) over tokens: the words
and one end.

Neither the trie nor the vocabulary has a bound, so neither is broadcast nor
brought to the driver:

1. Texts are dealt into chunks of at most ``CHUNK`` bytes. A chunk lists its
   distinct tokens (by 64-bit hash) and runs of ``DEPTH`` + 1 symbols with
   their counts in training, as sorted and packed arrays, one for each bucket.
2. A bucket sums its arrays over all chunks and answers each chunk with the
   tokens' counts and the runs' code lengths, in the order asked. Runs are
   dealt by the last ``SHARED`` symbols of their context, so all that the
   contexts of that length or more need is in the bucket. The counts of
   shorter contexts have at most 257 ** 3 entries, whatever the corpus, and are
   broadcast.
3. The answers meet their chunk, whose texts are scored.

The number of buckets follows the bytes of text, so that their size stays.

Null and empty texts have one token, the end. A null id is held out or not as
empty text is. Repeated rows each count. Without training texts the base is
log10(0.5 / 0.5) = 0 a token and the model gives 1/257 a symbol. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Scratch, text_of
from orderloom.llm.tokens import slices

SYMBOLS = 257
#: Stands before and after a text.
EDGE = 256
#: Symbols of the longest context; of those that decide the bucket; and of the longest whose counts are broadcast.
DEPTH, SHARED, SHORT = 5, 3, 2
CHUNK = 4 << 20
#: Bytes of text that make a bucket more.
BUCKET = 32 << 20
#: Bytes of text whose runs are made at once, and contexts that are blended at once.
PART, BLEND = 1 << 19, 1024
#: The token at the end of a text; no word is empty.
END = b""

Counts = tuple[np.ndarray, np.ndarray]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def hashed(tokens) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64)


def runs(texts: list[str | None], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Of each symbol to predict, ends included, the run that ends in it as one number; and how many each text has."""
    parts = [_runs(texts[a:b], depth) for a, b in slices([len(t or "") for t in texts], PART)]
    return tuple(np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*parts, strict=True))


def _runs(texts: list[str | None], depth: int) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").encode().lower() for t in texts]
    sizes = np.array([len(b) for b in raw], np.int64)
    begin = np.cumsum(sizes + depth + 1) - (sizes + depth + 1)
    symbols = np.full(int((sizes + depth + 1).sum()), EDGE, np.int64)
    inside = np.arange(int(sizes.sum())) + np.repeat(depth + (depth + 1) * np.arange(len(raw)), sizes)
    symbols[inside] = np.frombuffer(b"".join(raw), np.uint8)
    codes = np.zeros(len(symbols) - depth if len(symbols) else 0, np.int64)
    for k in range(depth + 1):
        codes = codes * SYMBOLS + symbols[k : len(symbols) - depth + k]
    own = np.repeat(np.arange(len(raw)), sizes + 1)
    return codes[np.arange(len(own)) + depth * own], sizes + 1


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, in any order, and the place of each code among them."""
    encoded = pa.array(codes).dictionary_encode()
    return encoded.dictionary.to_numpy(), encoded.indices.to_numpy()


def summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> Counts:
    found, where = np.unique(np.concatenate([np.empty(0, np.int64), *codes]), return_inverse=True)
    return found, np.bincount(where, np.concatenate([np.empty(0), *counts]), len(found)).astype(np.int64)


def bucket_of_run(codes: np.ndarray, buckets: int) -> np.ndarray:
    shared = (codes // SYMBOLS % SYMBOLS**SHARED).astype(np.uint64)
    return ((shared * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def bucket_of_token(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Bytes of one place together, compressed."""
    import zstandard

    raw = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), raw.itemsize).T).tobytes()) if len(raw) else b""


def unpack(raw: bytes, dtype) -> np.ndarray:
    import zstandard

    if not raw:
        return np.empty(0, dtype)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def _rising(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


# The model


def blend(levels: list[np.ndarray]) -> np.ndarray:
    """Probabilities of all symbols (columns) in contexts (rows), from their counts in the longest context down to none."""
    p, seen = np.zeros(levels[0].shape), np.zeros(levels[0].shape, bool)
    left = np.ones((len(p), 1))  # what has escaped so far
    for level in levels:
        free = np.where(seen, 0, level)
        total, kinds = free.sum(axis=1, keepdims=True), (free > 0).sum(axis=1, keepdims=True)
        seen |= free > 0
        kinds = np.where(seen.all(axis=1, keepdims=True), 0, kinds)  # nothing left to escape to
        p += left * free / np.maximum(total + kinds, 1)
        left = left * np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1)
    rest = ~seen
    return p + left * rest / np.maximum(rest.sum(axis=1, keepdims=True), 1)


def _rows(table: Counts, contexts: np.ndarray) -> np.ndarray:
    """Counts of all symbols in the contexts, from sorted runs of one symbol more."""
    codes, counts = table
    low, high = np.searchsorted(codes, contexts * SYMBOLS), np.searchsorted(codes, (contexts + 1) * SYMBOLS)
    sizes = high - low
    at = np.arange(int(sizes.sum())) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
    out = np.zeros((len(contexts), SYMBOLS))
    out[np.repeat(np.arange(len(contexts)), sizes), codes[at] % SYMBOLS] = counts[at]
    return out


def shorter(table: Counts, symbols: int) -> Counts:
    """Counts of runs that end in the same ``symbols``."""
    return summed([table[0] % SYMBOLS**symbols], [table[1]])


def code_lengths(asked: np.ndarray, longest: Counts, short: Counts, depth: int = DEPTH) -> np.ndarray:
    """log10 of the probability of the last symbol of each run. ``longest`` has all training runs of the
    contexts asked for down to ``SHARED`` symbols, ``short`` those of ``SHORT`` + 1 symbols."""
    tables = [longest, *(shorter(longest, k + 1) for k in range(depth - 1, SHORT, -1)), short, *(shorter(short, k + 1) for k in range(SHORT - 1, -1, -1))]
    contexts, row = np.unique(asked // SYMBOLS, return_inverse=True)
    out, order = np.empty(len(asked), np.float32), np.argsort(row, kind="stable")
    cuts = np.searchsorted(row[order], np.arange(0, len(contexts) + BLEND, BLEND))
    for k, a in enumerate(range(0, len(contexts), BLEND)):
        some = contexts[a : a + BLEND]
        p = blend([_rows(t, some % SYMBOLS ** (depth - i)) for i, t in enumerate(tables)])
        mine = order[cuts[k] : cuts[k + 1]]
        out[mine] = np.log10(p[row[mine] - a, asked[mine] % SYMBOLS])
    return out


# The steps


def _ask(buckets: int):
    names = ["chunk", "bucket", "docs", "runs", "run_counts", "tokens", "token_counts"]

    def row(chunk: int, bucket: int | None, *blobs: bytes | None) -> list:
        return [chunk, bucket, *blobs]

    def of_chunk(chunk: int, ids: pa.Array, texts: pa.Array, train: list[bool]) -> list[list]:
        raw = texts.to_pylist()
        counts = Counter({END: sum(train)})
        for text, learn in zip(raw, train, strict=True):
            if learn:
                counts.update(words(text))
        others = set().union(*(words(t) for t, learn in zip(raw, train, strict=True) if not learn)).difference(counts)
        tokens, times = summed([hashed([*counts, *others]).view(np.int64)], [np.array([*counts.values(), *[0] * len(others)])])
        every, sizes = runs(raw)
        codes, where = distinct(every)
        n = np.bincount(where, np.repeat(np.array(train, float), sizes), len(codes)).astype(np.int64)
        order = np.argsort(codes)
        codes, n = codes[order], n[order]
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays([ids, texts], names=["id", "text"])
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        rows = [row(chunk, None, pack(np.frombuffer(sink.getvalue(), np.uint8)), None, None, None, None)]
        tokens = tokens.view(np.uint64)
        order = np.argsort(tokens)
        tokens, times = tokens[order], times[order]
        of_run, of_token = bucket_of_run(codes, buckets), bucket_of_token(tokens, buckets)
        by_run, by_token = np.argsort(of_run, kind="stable"), np.argsort(of_token, kind="stable")
        run_cuts, token_cuts = (np.searchsorted(of[by], np.arange(buckets + 1)) for of, by in ((of_run, by_run), (of_token, by_token)))
        for k in range(buckets):
            r, t = by_run[run_cuts[k] : run_cuts[k + 1]], by_token[token_cuts[k] : token_cuts[k + 1]]
            if len(r) or len(t):
                rows.append(row(chunk, k, None, _rising(codes[r]), pack(n[r]), _rising(tokens[t]), pack(times[t])))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(1)).to_pylist(), CHUNK):
                rows = of_chunk((task << 32) + k, batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a).to_pylist())
                k += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


ASKED = "chunk long, bucket long, docs binary, runs binary, run_counts binary, tokens binary, token_counts binary"


def _short_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counts = (np.empty(0, np.int64), np.empty(0, np.int64))
    for batch in batches:
        for raw, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            codes, counts = np.cumsum(unpack(raw, np.int64)), unpack(n, np.int64)
            found = shorter((codes[counts > 0], counts[counts > 0]), SHORT + 1)
            held = summed([held[0], found[0]], [held[1], found[1]])
    yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["code", "n"])


def _answer(short):
    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk").to_numpy()
        codes, run_counts, tokens, token_counts = ([unpack(x, kind) for x in table.column(c).to_pylist()] for c, kind in (("runs", np.int64), ("run_counts", np.int64), ("tokens", np.uint64), ("token_counts", np.int64)))
        codes, tokens = [np.cumsum(x) for x in codes], [np.cumsum(x) for x in tokens]
        known, n = summed(codes, run_counts)
        lengths = code_lengths(known, (known[n > 0], n[n > 0]), short.value)
        vocabulary, where = np.unique(np.concatenate(tokens), return_inverse=True)
        c = np.bincount(where, np.concatenate(token_counts), len(vocabulary)).astype(np.int64)
        answers = [(pack(lengths[np.searchsorted(known, x)]), pack(c[np.searchsorted(vocabulary, y)])) for x, y in zip(codes, tokens, strict=True)]
        first = np.arange(len(chunk)) == 0  # the sums of the bucket stand on one of its rows
        return pa.table({"chunk": chunk, "bucket": table.column("bucket"), "lengths": pa.array([x for x, _ in answers], pa.binary()), "counts": pa.array([y for _, y in answers], pa.binary()),
                         "n_train": np.where(first, c.sum(), 0), "n_vocabulary": np.where(first, (c > 0).sum(), 0)})

    return run


ANSWERED = "chunk long, bucket long, lengths binary, counts binary, n_train long, n_vocabulary long"


def _score(buckets: int, n_train: int, n_vocabulary: int):
    def of_chunk(docs: pa.Table, lengths: np.ndarray, counts: np.ndarray) -> pa.Table:
        texts = docs.column("text").to_pylist()
        tokens = list(set().union([END], *map(words, texts)))
        hashes = hashed(tokens)
        asked, where = np.unique(hashes, return_inverse=True)
        c = np.empty(len(asked), np.int64)
        c[np.argsort(bucket_of_token(asked, buckets), kind="stable")] = counts
        c = c[where]
        log = dict(zip(tokens, np.log10((c + 0.5) / (n_train + 0.5 * (n_vocabulary + 1))).tolist(), strict=True))
        unknown = {t for t, new in zip(tokens, (c == 0).tolist(), strict=True) if new}
        n_tokens, n_known, base = [], [], []
        for text in texts:
            own = words(text)
            own.append(END)
            n_tokens.append(len(own))
            n_known.append(len(own) - sum(map(unknown.__contains__, own)))
            base.append(sum(map(log.__getitem__, own)))

        every, sizes = runs(texts)
        asked, where = distinct(every)
        length = np.empty(len(asked))
        length[np.lexsort((asked, bucket_of_run(asked, buckets)))] = lengths
        score = np.add.reduceat(length[where], np.cumsum(sizes) - sizes)
        columns = [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(score)]
        return pa.table([docs.column("id"), *columns], names=["id", "n_tokens", "n_known", "base_score", "score"])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("bucket")
        lengths, counts = (np.concatenate([unpack(x, kind) for x in answers.column(c).to_pylist()]) for c, kind in (("lengths", np.float32), ("counts", np.int64)))
        (raw,) = docs.column("docs").to_pylist()
        return of_chunk(pa.ipc.open_stream(unpack(raw, np.uint8).tobytes()).read_all(), lengths, counts)

    return run


def scored(docs: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score (both log10) of every row. ``trains`` says which rows are learnt from."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = -(-size // BUCKET) or 1
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.coalesce(trains, F.lit(False)).alias("train"))
    asked = scratch.keep(rows.mapInArrow(_ask(buckets), ASKED), "asked")

    requests = asked.where("bucket is not null")
    found = requests.select("runs", "run_counts").mapInArrow(_short_runs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    short = spark.sparkContext.broadcast((found.column("code").to_numpy(), found.column("n").to_numpy()))  # 257 ** 3 entries at most
    answers = scratch.keep(requests.drop("docs").groupBy("bucket").applyInArrow(_answer(short), ANSWERED), "answers")
    n_train, n_vocabulary = (x or 0 for x in answers.agg(F.sum("n_train"), F.sum("n_vocabulary")).first())

    packed = asked.where("bucket is null").select("chunk", "docs")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")), *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))])
    answered = answers.select("chunk", "bucket", "lengths", "counts")
    out = packed.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(_score(buckets, n_train, n_vocabulary), schema)
    return out.withColumn("train_tokens", F.lit(n_train).cast("long"))
