"""Repeated byte strings cut out of documents, found in merged Burrows-Wheeler transforms of shards.

What is cut: each byte covered by a string of ``length`` bytes that also starts
anywhere else, in the same document or another. Strings are judged on the input
and never reach across documents.

1. *Deal.* All windows of ``length`` bytes that hold the same text must meet.
   The anchor of a window is the ``gram`` bytes of least hash in it (the first
   of equals), which its text alone decides. Neighbouring windows with one
   anchor travel as one string; what a string weighs is how often it occurs. An
   anchor that occurs once can have no repeated window; a string that is its
   anchor's only one is repeated as a whole if it weighs two or more, as there
   is nothing to merge it with.
2. *Merge.* The other strings, each once, meet by anchor. Their suffixes are
   listed by shard as Burrows-Wheeler transforms, which are merged by refining
   an interleave (``bwt``): it tells the bytes that neighbours have in common,
   and so the intervals of suffixes that share ``length`` bytes. Windows whose
   interval weighs two or more are repeated.
3. *Cut.* Repeated windows go back to every place of their strings.

An anchor may stand in any number of different strings. Where it has more than
``most_strings``, its windows are dealt anew by a longer text: windows at
nearly the same distance from the anchor have more than the anchor in common,
and the range of distances is halved until no group is too large. At one
distance a group is a single string.

Strings are told apart by two hashes of 64 bits, that of the anchor and that of
the whole, and texts by SHA-256. A null text counts as empty. Every row is a
document of its own, whatever its id; texts in several rows are repeats of each
other. A text shorter than ``length`` is kept. An empty table gives no rows. A
text is one value in a task, with its strings, so it should stay below some
hundred MB; it is worked through in pieces of 1 MB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import bwt
from orderloom.llm.common import Scratch
from orderloom.llm.tokens import slices

PIECE = 1 << 20
#: Bytes of strings whose transforms are merged at a time, and of one shard of them.
MERGED_BYTES, SHARD_BYTES = 1_900_000, 1 << 19
#: Of one anchor; more are dealt anew.
MOST_STRINGS = 4_096
LOW = np.uint64(0xFFFFFF)
BASE = 0x9E3779B97F4A7C15
#: One odd number of 64 bits for each byte.
BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([b])) | 1 for b in range(256)], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out, have = np.ones(n, np.uint64), 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


class Anchors:
    """Cuts texts into strings: runs of windows with one anchor."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.windows = length, gram, length - gram + 1
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.up):
            self._grow(2 * n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTES[data] * self.up[:n], out=total[1:])
        h = (total[self.gram :] - total[: -self.gram]) * self.down[: n - self.gram + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h

    def strings(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows, anchor's hash and anchor's distance from the first window, of texts laid end to end."""
        if len(data) < self.length:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        h = self._hashes(data)
        least, have = (h & ~LOW) | np.arange(len(h), dtype=np.uint64), 1
        while have < self.windows:
            step = min(have, self.windows - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        anchor = (least & LOW).astype(np.int64)
        text_end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[: len(anchor)]
        inside = np.arange(len(anchor)) + self.length <= text_end
        change = anchor[1:] != anchor[:-1]
        first = np.flatnonzero(inside & np.concatenate([[True], change | ~inside[:-1]]))
        last = np.flatnonzero(inside & np.concatenate([change | ~inside[1:], [True]]))
        return first, last - first + 1, h[anchor[first]].view(np.int64), anchor[first] - first


STRINGS = "doc long, start long, windows int, times int, weight long, distance int, anchor long, string long, digest binary"


def _strings(length: int, gram: int):
    names = [c.split()[0] for c in STRINGS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def rows(cut: Anchors, laid: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        raw = b"".join(t for *_, t in laid)
        ends = np.cumsum([len(t) for *_, t in laid])
        first, windows, anchor, distance = cut.strings(np.frombuffer(raw, np.uint8), ends)
        piece = np.searchsorted(ends, first, "right")
        doc, at, copies = (np.array([x[i] for x in laid], np.int64)[piece] for i in range(3))
        start = first - np.concatenate([[0], ends])[piece] + at
        ends_at = (first + windows + length - 1).tolist()
        string = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), ends_at, strict=True)], np.uint64).view(np.int64)
        # The same string again and again, as in a run of one letter, is one row.
        again = (anchor[1:] == anchor[:-1]) & (string[1:] == string[:-1]) & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + windows[:-1])
        head = np.flatnonzero(np.concatenate([[True], ~again])[: len(first)])
        times = np.diff(np.append(head, len(first)))
        columns = [doc[head], start[head], windows[head], times, copies[head] * times, distance[head], anchor[head], string[head]]
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.nulls(len(head), pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, doc = Anchors(length, gram), TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(0)).fill_null(0).to_pylist(), PIECE):
                texts: dict[bytes, list] = {}
                for t in batch.column(0).slice(a, b - a).to_pylist():
                    if t is not None and len(t) >= length:
                        texts.setdefault(hashlib.sha256(t).digest(), [t, 0])[1] += 1
                whole = [(doc + i, t, n) for i, (t, n) in enumerate(texts.values())]
                doc += len(whole)
                n = len(whole)
                if n:
                    columns = [[d for d, _, _ in whole], [-1] * n, *[[0] * n] * 6, list(texts)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
                laid = [(d, at, n, t[at : at + PIECE + length - 1]) for d, t, n in whole for at in range(0, len(t) - length + 1, PIECE)]
                for x, y in slices([len(t) for *_, t in laid], 2 * PIECE):
                    yield rows(cut, laid[x:y])

    return run


ASKED = "anchor long, string long, weight long, distance int, windows int, text binary"


def _fetch(length: int):
    """The strings asked for, out of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, asked = batch.column(0)[i].as_buffer(), batch.column(1).slice(i, 1).flatten()
                start, windows = asked.field("start").to_numpy(), asked.field("windows").to_numpy()
                for a in range(0, len(asked), 10_000):
                    some = asked.slice(a, 10_000)
                    cut = [text.slice(p, n + length - 1).to_pybytes() for p, n in zip(start[a : a + 10_000].tolist(), windows[a : a + 10_000].tolist())]
                    names = ["anchor", "string", "weight", "distance", "windows"]
                    yield pa.RecordBatch.from_arrays([*(some.field(c) for c in names), pa.array(cut, pa.binary())], names=[*names, "text"])

    return run


FOUND = "anchor long, string long, found array<int>"


def _runs(hit: np.ndarray) -> np.ndarray:
    """Runs of True as [first, past the last, first, ...]."""
    return np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).astype(np.int32)


def _merge(length: int, merged_bytes: int, shard_bytes: int):
    width = bwt.width_for(length)

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("anchor").to_numpy(), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        anchor, size = table.column("anchor").to_numpy(), pc.binary_length(table.column("text")).to_numpy()
        group = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        keep, runs = [], []
        for x, y in slices(np.add.reduceat(size, group).tolist(), merged_bytes):
            a, b = int(group[x]), int(group[y]) if y < len(group) else len(anchor)
            some = table.slice(a, b - a)
            end = np.cumsum(size[a:b])
            strings = bwt.Strings(np.frombuffer(b"".join(some.column("text").to_pylist()), np.uint8), end - size[a:b], end, width)
            hit = bwt.repeated(strings, some.column("weight").to_numpy(), length, shard_bytes)
            for i, (p, q) in enumerate(zip(strings.start.tolist(), end.tolist(), strict=True)):
                if len(found := _runs(hit[p:q])):
                    keep.append(a + i)
                    runs.append(found)
        found = pa.array(runs, pa.list_(pa.int32()))
        return pa.table([table.column("anchor").take(pa.array(keep, pa.int64())), table.column("string").take(pa.array(keep, pa.int64())), found], names=["anchor", "string", "found"])

    return run


DEALT = "anchor0 long, string0 long, first int, " + ASKED


def _deal_anew(length: int, windows: int, width: int):
    """Strings cut where the distance of their windows from the anchor passes a multiple of ``width``, under what such windows have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, string, weight, distance, n, text in zip(*(batch.column(c).to_pylist() for c in ("anchor", "string", "weight", "distance", "windows", "text")), strict=True):
                nearest = distance - n + 1
                for cell in range(nearest // width, distance // width + 1):
                    low, high = cell * width, min((cell + 1) * width, windows) - 1
                    far, near = min(high, distance), max(low, nearest)
                    first = distance - far
                    part = text[first : distance - near + length]
                    shared = text[distance - low : distance - high + length]
                    out.append((anchor, string, first, xxhash.xxh3_64_intdigest(shared, seed=cell) - (1 << 63), xxhash.xxh3_64_intdigest(part) - (1 << 63), weight, far, far - near + 1, part))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()], strict=True)], names=[c.split()[0] for c in DEALT.split(", ")])

    return run


def _merged(strings: DataFrame, scratch: Scratch, length: int, windows: int, most_strings: int, merged_bytes: int, shard_bytes: int) -> DataFrame:
    """anchor, string, found: of each string its runs of repeated windows, as first, past the last, first, ..."""
    level, width, results, links = 0, windows, [], []
    while True:
        sizes = strings.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.octet_length("text")).alias("n_bytes"))
        sizes = scratch.keep(sizes, f"sizes{level}")
        fits, total = sizes.agg(F.coalesce(F.min(F.col("kinds") <= most_strings), F.lit(True)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
        large = sizes.where(F.col("kinds") > most_strings).select("anchor")
        small = strings if fits else strings.join(large, "anchor", "left_anti")
        buckets = -(-total // merged_bytes) or 1
        dealt = small.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets).cast("long")))
        results.append(scratch.keep(dealt.groupBy("bucket").applyInArrow(_merge(length, merged_bytes, shard_bytes), FOUND), f"found{level}"))
        if fits:
            break
        level, width = level + 1, -(-width // 2)
        anew = scratch.keep(strings.join(large, "anchor", "left_semi").select(*[c.split()[0] for c in ASKED.split(", ")]).mapInArrow(_deal_anew(length, windows, width), DEALT), f"anew{level}")
        links.append(anew.select("anchor0", "string0", "first", "anchor", "string"))
        firsts = [F.first(c).alias(c) for c in ("distance", "windows", "text")]
        strings = scratch.keep(anew.groupBy("anchor", "string").agg(F.sum("weight").alias("weight"), *firsts), f"strings{level}")
    found = results.pop()
    while links:  # back from the cut strings to those they were cut from
        back = links.pop().join(found, ["anchor", "string"]).select(F.col("anchor0").alias("anchor"), F.col("string0").alias("string"), F.expr("transform(found, x -> x + first)").alias("part"))
        back = back.groupBy("anchor", "string").agg(F.flatten(F.collect_list("part")).alias("found"))
        found = scratch.keep(results.pop().unionByName(back), f"back{len(links)}")
    return found


def spans_of(n_bytes: int, length: int, starts: np.ndarray, windows: np.ndarray, times: np.ndarray, found: list) -> np.ndarray:
    """The maximal runs of bytes under repeated windows, as [start, stop, start, ...]."""
    turn = np.zeros(n_bytes + 2, np.int32)
    for p, n, k, runs in zip(starts.tolist(), windows.tolist(), times.tolist(), found, strict=True):
        at = p + n * np.arange(k)
        for a, b in zip(runs[::2], runs[1::2], strict=True):
            turn[at + a] += 1  # places of one string's repeats differ
            turn[at + (b + length - 1)] -= 1
    return _runs(np.cumsum(turn[: n_bytes + 1])[:n_bytes] > 0)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                if not found.is_valid:
                    spans.append([])
                    kept.append(raw)
                    continue
                some = found.values
                edges = spans_of(len(raw), length, *(some.field(c).to_numpy() for c in ("start", "windows", "times")), some.field("found").to_pylist()).tolist()
                spans.append([{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2])])
                bounds = [0, *edges, len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            struct = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(spans, struct), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return run


def cut_repeats(
    docs: DataFrame,
    length: int = 200,
    id_col: str = "doc_id",
    text_col: str = "text",
    gram: int | None = None,
    most_strings: int = MOST_STRINGS,
    merged_bytes: int = MERGED_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """id, n_bytes, spans (start, stop) of removed bytes, and the kept bytes, of every row."""
    gram = gram or -(-length * 8 // 25)
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    kind = docs.schema[id_col].dataType.simpleString()

    cut = scratch.keep(rows.select("text").mapInArrow(_strings(length, gram), STRINGS), "strings")
    texts = scratch.keep(cut.where("start < 0").select("doc", "digest"), "texts")
    strings = cut.where("start >= 0").drop("digest")
    anchors = strings.groupBy("anchor").agg(F.sum("weight").alias("total"), F.min("string").alias("low"), F.max("string").alias("high"))
    anchors = anchors.where("total > 1").select("anchor", (F.col("low") == F.col("high")).alias("alone"))
    candidates = scratch.keep(strings.join(anchors, "anchor"), "candidates")
    scratch.remove("strings")

    firsts = [F.first(c).alias(c) for c in ("doc", "start", "windows", "distance")]
    kinds = candidates.where(~F.col("alone")).groupBy("anchor", "string").agg(F.sum("weight").alias("weight"), *firsts)
    asked = kinds.join(texts, "doc").groupBy("digest").agg(F.collect_list(F.struct("anchor", "string", "weight", "distance", "windows", "start")).alias("asked"))
    one_each = rows.where(F.octet_length("text") >= length).groupBy(digest.alias("digest")).agg(F.first("text").alias("text"))
    fetched = scratch.keep(one_each.join(asked, "digest").select("text", "asked").mapInArrow(_fetch(length), ASKED), "fetched")
    found = _merged(fetched, scratch, length, length - gram + 1, most_strings, merged_bytes, shard_bytes)

    whole = candidates.where("alone").select("doc", "start", "windows", "times", F.array(F.lit(0), "windows").alias("found"))
    parts = candidates.where(~F.col("alone")).join(found, ["anchor", "string"]).select("doc", "start", "windows", "times", "found")
    of_doc = whole.unionByName(parts).groupBy("doc").agg(F.collect_list(F.struct("start", "windows", "times", "found")).alias("found"))
    one_doc = texts.groupBy("digest").agg(F.min("doc").alias("doc"))  # a text may have come in several batches
    of_text = scratch.keep(of_doc.join(one_doc, "doc").select("digest", "found"), "repeats")
    both = rows.withColumn("digest", digest).join(of_text, "digest", "left").select("id", "text", "found")
    return both.mapInArrow(_cut(length), f"id {kind}, n_bytes long, spans array<struct<start: bigint, stop: bigint>>, kept binary")
