"""Filter audit and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from cases import DOCS, documents
from pyspark.sql import functions as F

from orderloom.llm import filter_audit, importance
from orderloom.llm.common import Scratch

LABELS = [(1, 1, 0), (5, 1, 1), (6, 0, 1), (6, 1, 0), (8, 1, 0), (15, None, 1), (16, 1, None), (None, 1, 1), (99, 1, 1)]


def plain_fails(text, i, all_texts):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = [j for j, t in all_texts if t == text and j is not None and (i is None or j < i)]
    return "".join(
        f
        for f, failed in zip(
            "ABCDE",
            (
                len(words) < 100,
                100 * len(set(words)) < 80 * len(words),
                100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                re.search("[#$%&*|]", text),
                smaller,
            ),
        )
        if failed
    )


def plain_audit(docs, labels):
    texts = [(i, t or "") for i, t, _ in docs]
    out = []
    for part in {p or "" for *_, p in docs}:
        mine = [(i, set(plain_fails(t or "", i, texts))) for i, t, p in docs if (p or "") == part]
        good, toxic = ({i for i, *said in labels if said[k] == 1 and i is not None} for k in range(2))
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                reach = [x for x in mine if not x[1] & set(order[: step - 1])]
                gone = [i for i, fails in reach if f in fails]
                shapley[f] += len(gone)
                rows.append((f, part, "".join(order), step, len(reach) - len(gone), len(gone), sum(f in x[1] for x in mine) - len(gone),
                             sum(x[1] == {f} for x in mine), sum(i in good for i in gone), sum(i in toxic for i in gone)))
        out += [(*row, shapley[f]) for f, *row in rows]
    return sorted(out)


def audit(spark, docs, labels):
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(map(tuple, filter_audit.interactions(filter_audit.failures(docs, part_col="source"), said).collect()))


def test_audit_equals_filtering_in_every_order(spark):
    assert audit(spark, documents(spark), LABELS) == plain_audit(DOCS, LABELS)


def test_audit_of_random_documents(spark):
    rng = random.Random(4)
    pool = ["word", "other", "LOUD", "a#b", "é", "x", "the", "of"]
    texts = [" ".join(rng.choice(pool[: rng.randrange(1, 8)]) + str(rng.randrange(rng.choice((1, 500)))) for _ in range(rng.choice((5, 99, 100, 140)))) for _ in range(25)]
    docs = [(rng.choice((None, *range(40))), rng.choice([*texts, None]), rng.choice((None, "", "a", "b"))) for _ in range(80)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 40, 2)]
    assert audit(spark, documents(spark, docs), labels) == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    assert audit(spark, documents(spark, []), LABELS) == []
    assert len(audit(spark, documents(spark, [(None, None, None)]), [])) == 600


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_survivors_of_every_set(n):
    cells = np.random.default_rng(n).integers(0, 9, (1 << n, 3))
    for state in range(1 << n):
        assert (filter_audit.survivors(cells)[state] == cells[[m for m in range(1 << n) if not m & state]].sum(axis=0)).all()


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in [*words, *map(" ".join, zip(words, words[1:]))]]


def plain_resample(docs, target):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [x for _, x, _ in docs]), (t, target)):
        for x in texts:
            for b in plain_features(x)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for i, text, _ in docs:
        words, found = plain_features(text)
        weight = math.floor(sum(gain[b] for b in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return rows


TARGET = ["the quick brown fox", None, "wizards brew a potion " * 9, ""]


def test_drawn_documents_equal_a_plain_draw(spark):
    docs = [d for d in DOCS] + [(100 + k, f"{DOCS[4][1]} {k}", "z") for k in range(40)]
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    for percent in (25, 100, 0):
        found = importance.resample(documents(spark, docs), target, percent=percent).collect()
        plain = plain_resample(docs, TARGET)
        assert sorted(map(tuple, found), key=repr) and sorted((tuple(r)[:5] for r in found), key=repr) == sorted(plain, key=repr)
        able = sorted((-r[4], r[0] is None, r[0] or 0) for r in plain if r[1] >= 20)
        drawn = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
        assert [r["rank"] for r in drawn] == list(range(1, len(able) * percent // 100 + 1))
        assert [(-r.score, r.id is None, r.id or 0) for r in drawn] == able[: len(drawn)]


def test_resampling_nothing(spark):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(documents(spark, []), none).collect() == []
    assert {(r.weight, r["rank"]) for r in importance.resample(documents(spark, [(None, None, None)] * 3), none).collect()} == {(0, None)}


@pytest.mark.parametrize("pivots", [1, 2, 5, 32])
def test_the_kth_key_is_that_of_a_sort(spark, pivots):
    """Equal scores and ids, null ids."""
    rng = random.Random(pivots)
    keys = [(rng.randrange(4), i is None, i, row) for row, i in enumerate(rng.choice((None, 1, 2, 3)) for _ in range(60))]
    ordered = sorted(keys, key=lambda k: (k[0], k[1], k[2] or 0, k[3]))
    rows = spark.createDataFrame(keys, "a long, b boolean, c long, d long").repartition(4)
    for k in (1, 2, 17, 30, 59, 60):
        assert tuple(importance.kth(rows, k, Scratch(spark), 7, pivots)) == ordered[k - 1]


def test_clashing_columns_and_ids_as_text(spark):
    docs = documents(spark).withColumn("doc_id", F.col("doc_id").cast("string"))
    for name in ("id", "row", "score", "n_words", "rank", "a", "named", "mask", "digest", "part"):
        docs = docs.withColumn(name, F.lit(f"more {name}"))
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    plain = importance.resample(documents(spark), target, least_words=1).collect()
    more = importance.resample(docs, target, least_words=1).collect()
    assert {(str(r.id), r.weight, r.score) for r in plain} == {(str(r.id), r.weight, r.score) for r in more}
    assert audit(spark, documents(spark), LABELS) == audit(spark, docs.withColumn("doc_id", F.col("doc_id").cast("long")), LABELS)
