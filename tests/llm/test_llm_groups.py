"""Near-duplicates of texts and vectors, and the mix, against plain versions."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import DOCS, documents, prose
from pyspark.sql import functions as F

from orderloom.llm import components as cc
from orderloom.llm import embedding_dedup, mixing, simhash
from orderloom.llm.common import Scratch


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def plain_fingerprint(text, shingle=3):
    raw = "".join(c.lower() if c.isascii() else c for c in text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_documents(spark):
    found = sorted(simhash.near_duplicates(documents(spark)).collect(), key=repr)
    fps = [plain_fingerprint(t) for _, t, _ in DOCS]
    groups = Union(len(DOCS))
    for a in range(len(DOCS)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                groups.join(a, b)
    first = {}
    for k, (i, _, _) in enumerate(DOCS):
        if i is not None:
            first[groups.find(k)] = min(i, first.get(groups.find(k), i))
    want = [(i, fps[k] - (1 << 64) if fps[k] >> 63 else fps[k], first.get(groups.find(k))) for k, (i, _, _) in enumerate(DOCS)]
    assert [tuple(r) for r in found] == sorted(want, key=repr)
    kept = simhash.keep_one(documents(spark)).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == sorted({c for _, _, c in want}, key=repr)


def test_simhash_keeps_a_row_of_every_component(spark):
    unlike = [prose(k, 80) for k in (3, 4, 5, 7)]
    fps = [plain_fingerprint(t) for t in unlike]
    assert min((a ^ b).bit_count() for i, a in enumerate(fps) for b in fps[:i]) > 2
    given = [
        (None, unlike[0], "a"), (None, unlike[1], "b"),  # null ids, unlike texts
        (5, unlike[2], "c"), (5, unlike[3], "d"),  # one id, unlike texts, the first a copy of a smaller id's
        (2, unlike[2].upper(), "e"), (None, unlike[2], "f"),
    ]
    found = sorted((r.source for r in simhash.keep_one(documents(spark, given)).collect()))
    assert found == ["a", "b", "d", "e"]


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_simhash_links_of_dense_groups(spark, max_bits):
    rng, fps = np.random.default_rng(max_bits), set()
    for base in rng.integers(0, 2**63, 12).tolist():
        for _ in range(60):
            fps.add(base ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 5)))))
        fps |= {base ^ 1 << i ^ 1 << j for i in range(16) for j in range(i)}  # a long list under one key
    fps = sorted(fps)
    groups = Union(len(fps))
    raw = np.array(fps, np.uint64)
    for a in range(len(fps)):
        for b in np.flatnonzero(np.bitwise_count(raw[:a] ^ raw[a]) <= max_bits):
            groups.join(a, int(b))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits)
    found = {r.node: r.component for r in cc.components(links, Scratch(spark)).collect()}
    label = [found.get(s, s) for s in signed]
    assert len(set(label)) == len({groups.find(k) for k in range(len(fps))})
    assert len({(x, groups.find(k)) for k, x in enumerate(label)}) == len(set(label))


def test_simhash_links_are_given_while_batches_come():
    taken, mask = [], 0x00FFFFFFFFFFFF00  # of pairs that differ in the lowest byte alone
    choice = simhash.masks(2).index(mask)

    def batches():
        for k in range(4):
            taken.append(k)
            fps = np.array([k << 50, k << 50 | 1, k << 50 | 3], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(3, choice)), pa.array(fps & mask), pa.array(fps)], names=["choice", "key", "fp"])

    found = simhash._links(2)(batches())
    first = next(found)
    assert taken == [0] and first.num_rows == 0  # its one list may go on
    assert next(found).num_rows == 2 and taken == [0, 1]
    assert sum(b.num_rows for b in found) == 6 and taken == [0, 1, 2, 3]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(0, 90)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    links = [*chain, *[(b, a) for a, b in star], (5000, 5000), (7, 7), (2000, 2001), (2001, 2000), (2001, 2000)]
    found = {r.node: r.component for r in cc.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark)).collect()}
    assert found == {**{i: 0 for i in range(91)}, **{1000 + i: 1000 for i in range(200)}, 2000: 2000, 2001: 2000}
    assert cc.components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def plain_vectors(given, limit=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in given]
    groups, links = Union(len(given)), [0] * len(given)
    vectors = [np.array(v, float) if o else None for (_, v), o in zip(given, ok, strict=True)]
    for a in range(len(given)):
        for b in range(a):
            if ok[a] and ok[b] and len(vectors[a]) == len(vectors[b]):
                x, y = vectors[a], vectors[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= limit:
                    links[a] += 1
                    links[b] += 1
                    groups.join(a, b)
    return {(i, links[k], given[groups.find(k)][0]) for k, (i, _) in enumerate(given)}


@pytest.mark.parametrize("many_cells", [False, True])
def test_vectors(spark, monkeypatch, many_cells):
    if many_cells:
        monkeypatch.setattr(embedding_dedup, "CELL", 40)
        monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng, vectors = np.random.default_rng(0), []
    for centre in rng.normal(size=(8, 12)):
        vectors += [(centre + rng.normal(size=12) * rng.choice([0.02, 0.2, 0.33])).astype(np.float32).tolist() for _ in range(30)]
    vectors += [vectors[3]] * 25 + [[0.0] * 12, None, [2 * x for x in vectors[5]], [1.0, 2.0], [2.0, 4.0]]
    given = list(enumerate(vectors))
    found = embedding_dedup.near_duplicates(spark.createDataFrame(given, "vec_id long, embedding array<float>"))
    assert {(r.id, r.n_links, r.component_id) for r in found.collect()} == plain_vectors(given)


def test_vector_bounds_hold():
    rng = np.random.default_rng(2)
    units = embedding_dedup.unit(rng.normal(size=(300, 40)) * rng.choice([1e-3, 1, 1e30], (300, 1)))
    codes, scale, err = embedding_dedup.quantise(units)
    held = codes * scale[:, None]
    length = np.linalg.norm(held, axis=1)
    gap = np.abs(units @ units.T - held @ held.T)
    assert (gap <= err[:, None] * length[None] + err[None] + embedding_dedup.SLACK).all()


def plain_mix(docs, weights=(5, 2, 1), cap=3.0):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in order if s not in capped)
        if not rest:
            return sizes, {s: cap * sizes[s] for s in order}
        level = (total - sum(cap * sizes[s] for s in capped)) / rest
        over = {s for s in order if s not in capped and level * weight[s] > cap * sizes[s]}
        if not over:
            return sizes, {s: cap * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


@pytest.mark.parametrize(
    "docs",
    [
        DOCS,
        [(i, prose(i, 20 + i % 50), f"s{i % 7}") for i in range(400)],
        [(i, prose(i, 30), "big" if i % 3 else f"t{i % 40}") for i in range(600)],
        [(1, prose(1, 5), "a"), (2, prose(2, 500), "b"), (3, "", "c")],
        [(1, prose(1, 50), "only")],
    ],
)
def test_mix(spark, docs):
    sizes, target = plain_mix(docs)
    rows = mixing.mixed(documents(spark, docs)).collect()
    assert len(rows) == len(docs)
    by_size = {}
    for r in rows:
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r)
        assert r.times <= 3
    assert set(by_size) == {(sizes[s], round(target[s], 6)) for s in sizes}
    for (_, aim), own in by_size.items():
        sources = [s for s in sizes if sizes[s] == own[0].source_size and round(target[s], 6) == aim]
        taken = sum(r.times * r.size for r in own)
        assert abs(taken - aim * len(sources)) <= len(sources) * max(r.size for r in own)
    again = mixing.mixed(documents(spark, docs).repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)
    copies = mixing.repeated(documents(spark, docs)).groupBy("doc_id").count().collect()
    want = {}
    for r in rows:
        want[r.id] = want.get(r.id, 0) + r.times
    assert {r.doc_id: r["count"] for r in copies} == {i: n for i, n in want.items() if n}
