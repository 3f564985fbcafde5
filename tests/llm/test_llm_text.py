"""Classifier, cascade, licences, language model and line dedup against plain versions."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import DOCS, LINE, documents, prose
from pyspark.sql import functions as F

from orderloom.llm import license_scan, line_dedup, lm_scoring, quality_classifier, rule_cascade
from orderloom.llm.common import remainder

SF = "/root/testdata/sf0.1"


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held_out = remainder(F.col("doc_id")) == 0
    model = quality_classifier.train(docs, labels, ~held_out)
    found = quality_classifier.scored(docs.join(labels, "doc_id").where(held_out), model).select("quality", quality_classifier.SCORE).collect()
    assert all(0 <= s <= 1 for _, s in found)
    right = [(s >= 0.3) == bool(q) for q, s in found]
    assert sum(right) / len(right) > 0.98
    assert 0 < len(model.rules) < 200
    assert "if" in str(model)


def test_classifier_column_equals_the_rules_by_hand(spark):
    split = quality_classifier.Split
    model = quality_classifier.RuleEnsemble(-0.5, (((split(0, True, 3.0), split(4, False, 0.1)), 2.0), ((split(2, False, 0.5),), -1.0)))
    for text, score in quality_classifier.scored(documents(spark), model).select("text", quality_classifier.SCORE).collect():
        x = quality_classifier.statistics(text)
        total = -0.5 + 2.0 * (x[0] > 3.0 and x[4] <= 0.1) - 1.0 * (x[2] <= 0.5)
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(5, 1), (6, 1)], 4 / 5), ([(5, None), (6, 2)], 0.5), ([(99, 0)], 0.5)])
def test_classifier_without_both_kinds_of_labels(spark, labels, score):
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality_classifier.train(documents(spark), table)
    assert {round(r[0], 6) for r in quality_classifier.scored(documents(spark), model).select(quality_classifier.SCORE).collect()} == {round(score, 6)}


def test_cascade_order_and_short_circuit():
    cheap, dear, idle = (rule_cascade.Measured(n, s, r, 100) for n, s, r in (("cheap", 0.1, 10), ("dear", 2.0, 50), ("idle", 0.1, 0)))
    rules = tuple(rule_cascade.Rule(n, lambda s: True) for n in ("idle", "dear", "cheap"))
    ordered = rule_cascade.order(rules, [idle, dear, cheap])
    assert [r.name for r in ordered] == ["cheap", "dear", "idle"]

    def never(stats):
        raise AssertionError("a rule after the first that rejects must not run")

    import pyarrow as pa

    judged = rule_cascade._judge((rule_cascade.Rule("first", lambda s: s.n_words < 5), rule_cascade.Rule("second", never)), ())
    (out,) = judged([pa.RecordBatch.from_pydict({"id": [1], "text": ["a b"]})])
    assert out.column("failed").to_pylist() == ["first"]


def test_cascade_verdict_does_not_depend_on_the_order(spark):
    rules = rule_cascade.RULES
    kept = {tuple(r)[:1] + (r.failed is None,) for r in rule_cascade.judge(documents(spark), rules).collect()}
    assert {tuple(r)[:1] + (r.failed is None,) for r in rule_cascade.judge(documents(spark), rules[::-1]).collect()} == kept
    measured = rule_cascade.measure(documents(spark))
    assert {m.seen for m in measured} == {len(DOCS)} and {m.rule for m in measured} == {r.name for r in rules}


@pytest.mark.parametrize(
    ("text", "n"),
    [(None, 0), ("a b", 0), ("a b c", 0), ("a b c a b c", 6), ("a b c x a b c", 6), ("a a a a", 4), ("a a a", 0), ("x a b c y a b c a b c z", 9)],
)
def test_words_in_repeated_windows(text, n):
    words = (text or "").split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    assert rule_cascade.Stats(text).n_repeat_words == len(inside) == n


def test_cascade_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = rule_cascade.judge(docs.join(labels.where("quality = 1"), "doc_id"), report=("n_words", "n_repeat_words")).where("n_words >= 50 and 2 * n_repeat_words <= n_words")
    assert good.where("failed is not null").count() <= 0.01 * good.count()


def test_licences(spark):
    texts = {
        1: ("Some text first.\nReleased under the MIT License.\nMore.", ("MIT", 1.0)),
        2: ("  RELEASED under the mit license!  ", ("MIT", 1.0)),
        3: ("This work is licensed under the GNU General Public License, version 3", ("GPL-3.0", 1.0)),
        4: ("Licensed under CC BY-NC 4.0.", ("CC-BY-NC-4.0", 1.0)),
        5: ("Licensed under the law of the sea.", None),
        6: (prose(3), None),
        7: ("", None),
        8: (None, None),
        9: (dict((len(t), t) for _, t in license_scan.TEMPLATES)[max(len(t) for _, t in license_scan.TEMPLATES)].replace(" ", "\n"), ("MIT", 1.0)),
    }
    found = {r.id: r.matches for r in license_scan.scan(documents(spark, [(i, t, "a") for i, (t, _) in texts.items()])).collect()}
    for i, (_, want) in texts.items():
        assert [(m.license, m.dice) for m in found[i]] == ([] if want is None else [want]), i


VERSIONS = [
    ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
    ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ("Licensed under CC BY-SA 3.0", "CC-BY-SA-3.0"),
    ("Licensed under CC BY 4.0. 2 apples", "CC-BY-4.0"),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "CC-BY-3.0"),
    ("This work is licensed under the GNU General Public License, version 1.", "GPL-1.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This work is licensed under the GNU Library General Public License, version 2", "LGPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 7.", None),
    ("Licensed under CC BY 9.9", None),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("SPDX-License-Identifier: Nothing-5.0", None),
    ("MIT License\n\nCopyright 2024 Foo", "MIT"),
    ("The MIT License (MIT)", "MIT"),
    ("this code is licensed under GPLv3 by its authors", "GPL-3.0"),
    ("Licensed under MIT", "MIT"),
    ("All rights reserved.", None),
]


@pytest.mark.parametrize("text, name", VERSIONS)
def test_versions_variants_and_declared_identifiers(text, name):
    templates = license_scan.Templates(license_scan.known(), 0.8)
    for around in ("{}", f"{prose(3)} {{}}", f"{prose(3)}\n{{}}\n{prose(5)}"):
        found = {m[0] for m in license_scan.find(templates, around.format(text))}
        assert found == ({name} if name else set()), around


def test_a_long_header_of_a_version_without_template_has_no_name():
    templates = license_scan.Templates(license_scan.known(), 0.8)
    for version, name in (("1", "GPL-1.0"), ("2", "GPL-2.0"), ("5", None)):
        header = license_scan._gnu(license_scan._GPL, version, "program", ";")[0]
        assert {m[0] for m in license_scan.find(templates, f"{prose(2)}\n{header}\n{prose(4)}")} == ({name} if name else set())


def test_what_stands_equals_every_pair_compared():
    """A match gives way to one that explains half of its bigrams and is further above the limit."""
    rng = np.random.default_rng(11)
    for _ in range(200):
        given = []
        for n in range(rng.integers(1, 9)):
            first = int(rng.integers(0, 30))
            last = first + int(rng.integers(0, 8))
            shared = np.array([x for x in range(first, last + 1) if x in (first, last) or rng.random() < 0.7])
            given.append(license_scan.Match("ABC"[rng.integers(3)], float(rng.choice((0.8, 0.9, 1.0))), first, last, shared, float(rng.choice((0.0, 1.0, 2.0))) + n / 100))
        kept = []
        for m in sorted(given, key=lambda m: (-m.above, -m.dice, m.license, m.first)):
            explained = [2 * len(set(m.shared) & set(k.shared)) >= len(m.shared) for k in kept if k.license != m.license or k.dice >= m.dice]
            if not any(explained):
                kept.append(m)
        assert {id(m) for m in license_scan._standing(given)} == {id(m) for m in kept}


NOTICES_IN_PROSE = [
    ("This project is licensed under the MIT License.", "MIT"),
    ("Copyright 2024 Foo. Licensed under the MIT License.", "MIT"),
    ("one two three four five Licensed under the Apache License, Version 2.0. six seven eight nine", "Apache-2.0"),
    (f"{prose(3)} Released under the MIT License. {prose(4)}", "MIT"),
    (f"{prose(3)}\n{prose(5)} Licensed under\nthe MIT License. {prose(4)}\n", "MIT"),
    (f"{prose(1)} {' '.join(license_scan.TEMPLATES[2][1].split())} {prose(2)}", "Apache-2.0"),
]


def test_licences_inside_prose(spark):
    found = {r.id: r.matches for r in license_scan.scan(documents(spark, [(i, t, "a") for i, (t, _) in enumerate(NOTICES_IN_PROSE)])).collect()}
    assert {i: [(m.license, m.dice) for m in ms] for i, ms in found.items()} == {i: [(name, 1.0)] for i, (_, name) in enumerate(NOTICES_IN_PROSE)}
    assert [(m.first_line, m.n_lines) for m in found[4]] == [(1, 2)]


def test_licences_by_paragraph_and_whole(spark):
    gpl3 = [" ".join(p.split()) for p in license_scan._GPL3]
    texts = {i: (name, " ".join(" ".join(ps).split())) for i, (name, ps) in enumerate(license_scan.PARAGRAPHS)}
    texts |= {100 + i: (name, f"{prose(4)}\n\n{'\n\n'.join(ps)}\n\n{prose(2)}") for i, (name, ps) in enumerate(license_scan.PARAGRAPHS)}
    texts |= {200 + i: ("GPL-3.0", f"{prose(4)}\n\n{gpl3[0]}\n\n{prose(i)}\n\n{gpl3[1]}") for i in range(2)}
    texts[300] = "GPL-3.0 OR GPL-2.0", f"{prose(4)}\n{gpl3[1]} {prose(4)}"
    texts[301] = "BSD-3-Clause OR BSD-2-Clause", license_scan._BSD_END
    texts[302] = "MIT", license_scan._MIT[2]
    texts[303] = "AGPL-3.0", "This file is licensed under the GNU Affero General Public License, version 3"
    rows = license_scan.scan(documents(spark, [(i, t, "a") for i, (_, t) in texts.items()])).collect()
    for r in rows:
        best = max(m.dice for m in r.matches)
        assert min(m.license for m in r.matches if m.dice == best) == texts[r.id][0], texts[r.id]
        assert best == 1.0 or r.id == 303
    assert len(rows) == len(texts)
    assert all(len(r.matches) == 1 for r in rows if r.id < 200)


def test_licences_of_two_kinds_and_places():
    templates = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    header = " ".join(license_scan.TEMPLATES[2][1].split())
    cut = header.index("Unless")
    text = f"Licensed under the MIT {'Licensed under the MIT License. ' * 3}\n{header[:cut]} Licensed under CC BY 4.0. {header[cut:]}"
    found = license_scan.find(templates, text)
    assert [m[0] for m in found if m[0] == "MIT"] == ["MIT"] * 4
    assert {m[0] for m in found} == {"MIT", "Apache-2.0", "CC-BY-4.0"}


def test_licence_windows_equal_all_windows_by_hand():
    rng, named = np.random.default_rng(5), (("X", "a b c a d e"), ("Y", "b c d b e f g"))
    templates = license_scan.Templates(named, 0.8)
    hits = 0
    for _ in range(400):
        words = [w for _ in range(rng.integers(0, 4)) for w in [*rng.choice(list("abcdefgh"), rng.integers(0, 6)), *named[rng.integers(2)][1].split()] if rng.random() > 0.12]
        best = 0.0
        for _, text in named:
            b = license_scan.bigrams(text.split())
            for i in range(len(words)):
                for j in range(i + 2, len(words) + 1):
                    a = license_scan.bigrams(words[i:j])
                    best = max(best, 2 * len(a & b) / (len(a) + len(b)))
        found = [m.dice for k, (_, _, b) in enumerate(templates.found) if len(words) > 1 for m in templates._windows(license_scan.Row(words), k, np.array([p in b for p in zip(words, words[1:], strict=False)]))]
        assert max(found, default=0.0) == (best if best >= 0.8 else 0.0)
        assert bool(templates.matches(words)) == (best >= 0.8)
        hits += best >= 0.8
    assert hits > 10


def plain_trie(texts, depth):
    trie = defaultdict(lambda: defaultdict(int))
    for text in texts:
        s = [256] * depth + list((text or "").encode().lower()) + [256]
        for k in range(depth, len(s)):
            for d in range(depth + 1):
                trie[tuple(s[k - d : k])][s[k]] += 1
    return trie


def plain_score(trie, text, depth):
    s, total = [256] * depth + list((text or "").encode().lower()) + [256], 0.0
    for k in range(depth, len(s)):
        out, p = set(), 1.0
        for d in range(depth, -1, -1):
            row = {a: n for a, n in trie.get(tuple(s[k - d : k]), {}).items() if a not in out}
            if not row:
                continue
            total_n, kinds = sum(row.values()), 0 if len(out | row.keys()) == 257 else len(row)
            if s[k] in row:
                p *= row[s[k]] / (total_n + kinds)
                break
            p *= kinds / (total_n + kinds)
            out |= row.keys()
        else:
            p /= 257 - len(out)
        total += np.log10(p)
    return total


@pytest.mark.parametrize("small", [False, True])
def test_language_model_equals_a_plain_trie(spark, monkeypatch, small):
    if small:  # many chunks and buckets
        for name, size in (("CHUNK", 300), ("BUCKET", 5_000), ("PART", 100), ("BLEND", 7)):
            monkeypatch.setattr(lm_scoring, name, size)
    docs = [(i, t, s) for i, t, s in DOCS if i not in (None, 12)]
    learns = {i: zlib.crc32(str(i).encode()) % 5 != 1 for i, _, _ in docs}
    assert set(learns.values()) == {True, False}
    if small:  # workers are processes of their own and do not see the small sizes; the steps are run here
        found = {r[0]: r[1:] for r in in_this_process(docs, learns)}
    else:
        found = {r.id: tuple(r)[1:] for r in lm_scoring.scored(documents(spark, docs), remainder(F.col("doc_id")) != 1).collect()}
    trie, counts = plain_trie([t for i, t, _ in docs if learns[i]], lm_scoring.DEPTH), defaultdict(int)
    for i, text, _ in docs:
        for w in [*lm_scoring.words(text), b""] if learns[i] else []:
            counts[w] += 1
    n, v = sum(counts.values()), len(counts)
    for i, text, _ in docs:
        own = [*lm_scoring.words(text), b""]
        n_tokens, n_known, base, score = found[i][:4]
        assert (n_tokens, n_known) == (len(own), sum(counts.get(w, 0) > 0 for w in own))
        assert base == pytest.approx(sum(np.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in own))
        assert score == pytest.approx(plain_score(trie, text, lm_scoring.DEPTH), rel=1e-6)


def in_this_process(docs, learns):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in docs], pa.int64()), pa.array([t or "" for _, t, _ in docs]), pa.array([learns[i] for i, _, _ in docs])], names=["id", "text", "train"])
    buckets, task = 4, type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})())})
    real, lm_scoring.TaskContext = lm_scoring.TaskContext, task
    try:
        asked = pa.Table.from_batches(list(lm_scoring._ask(buckets)([batch])))
    finally:
        lm_scoring.TaskContext = real
    requests = asked.filter(pa.compute.is_valid(asked.column("bucket")))
    (short,) = lm_scoring._short_runs(iter(requests.select(["runs", "run_counts"]).to_batches()))
    held = type("Held", (), {"value": (short.column(0).to_numpy(), short.column(1).to_numpy())})
    answers = pa.concat_tables([lm_scoring._answer(held)(requests.filter(pa.compute.equal(requests.column("bucket"), k))) for k in sorted(set(requests.column("bucket").to_pylist()))])
    n, v = (pa.compute.sum(answers.column(c)).as_py() for c in ("n_train", "n_vocabulary"))
    packed = asked.filter(pa.compute.is_null(asked.column("bucket")))
    out = []
    for chunk in packed.column("chunk").to_pylist():
        mine = [t.filter(pa.compute.equal(t.column("chunk"), chunk)) for t in (packed, answers)]
        out += lm_scoring._score(buckets, n, v)(*mine).to_pylist()
    return [tuple(r.values()) for r in out]


def test_language_model_sums_to_one():
    codes, _ = lm_scoring.runs(["abcab", "zzé", None])
    found, n = lm_scoring.summed([codes], [np.ones(len(codes))])
    every = np.arange(257) + codes[3] // 257 * 257
    p = 10.0 ** lm_scoring.code_lengths(every, (found, n), lm_scoring.shorter((found, n), lm_scoring.SHORT + 1)).astype(float)
    assert p.sum() == pytest.approx(1, abs=1e-5)


def test_language_model_without_training(spark):
    for r in lm_scoring.scored(documents(spark), F.lit(False)).collect():
        assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0)
    (r,) = lm_scoring.scored(documents(spark, [(1, "ab", "a")]), F.lit(None)).collect()
    assert r.score == pytest.approx(3 * np.log10(1 / 257), rel=1e-6)


def plain_lines(docs, least_chars=40, least_docs=5):
    space = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(space))
    holders = defaultdict(set)
    for i, text, _ in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    low = lambda i: -1 if i is None else i
    out = []
    for i, text, _ in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < least_docs or low(i) == max(map(low, holders[key(x)]))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


REPEATING = [*DOCS, *((100 + i, f"{prose(i)}\n" + "\n".join(f"{LINE} {k}" for k in range(i)), "z") for i in range(12))]


@pytest.mark.parametrize("most", [line_dedup.HASHES_PER_TASK, 3])
def test_lines_equal_a_plain_count(spark, most):
    """With three lines to a part, the shard is dealt to many tasks."""
    found = line_dedup.drop_repeated_lines(documents(spark, REPEATING), most_lines=most).select("doc_id", "text", line_dedup.LINES, line_dedup.DROPPED)
    found = sorted(map(tuple, found.collect()), key=repr)
    assert found == plain_lines(REPEATING)
    assert sum(r[3] for r in found) > 5


def test_only_suspected_repeats_move_on(spark, monkeypatch):
    """However many shards there are, and so however large their filters are together."""
    monkeypatch.setattr(line_dedup, "HASHES_PER_SHARD", 50)
    rng = np.random.default_rng(3)
    lines = [f"line {n} of documents that all differ from each other" for n in range(3_000)]
    docs = [(i, "\n".join([*lines[i * 30 : i * 30 + 30], *(LINE for _ in range(2) if i % 2)]), "a") for i in rng.permutation(100).tolist()]
    kept = {}
    keep = line_dedup.Scratch.keep
    monkeypatch.setattr(line_dedup.Scratch, "keep", lambda self, rows, name: kept.setdefault(name, keep(self, rows, name)))
    found = line_dedup.drop_repeated_lines(documents(spark, docs), most_lines=20).select("doc_id", "text", line_dedup.LINES, line_dedup.DROPPED)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_lines(docs)
    assert kept["filters"].count() > 50 and kept["lines"].count() == 3_050
    assert 50 <= kept["suspects"].count() < 300


def test_bloom_filters_never_miss_a_repeat():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    twice = hashes[:300]
    one, two = line_dedup.Bloom(18), line_dedup.Bloom(18)
    for part in np.array_split(np.concatenate([hashes, twice]), 9):
        part = np.unique(part)
        two.add(part[one.has(part)])
        one.add(part)
    small = two.folded()
    assert small.log_bits < two.log_bits
    assert small.has(twice).all() and small.has(hashes[300:]).mean() < 0.2
