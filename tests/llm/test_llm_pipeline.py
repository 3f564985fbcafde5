"""The registered queries keep their contract, and every stage of the pipeline equals a plain version."""

import os
import sys
import zlib

import numpy as np
import pytest
from test_llm_groups import Union, plain_fingerprint
from test_llm_text import plain_lines
from test_llm_tokens import plain_ids

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline  # noqa: E402
from orderloom.llm import mixing, queries  # noqa: E402

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op2_": [("doc_id", "bigint"), ("license", "string"), ("dice", "double"), ("n_matches", "bigint"), ("matches", "array<struct<license:string,dice:double,first_line:bigint,n_lines:bigint>>")],
    "op3_": [("doc_id", "bigint"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")],
    "op4_": [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")],
    "op5_": [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")],
    "op6_": [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", "boolean"), ("kept", "boolean")],
    "op7_": [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")],
    "op8_": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
    "op9_": [("doc_id", "bigint"), ("n_lines", "bigint"), ("n_dropped", "bigint"), ("kept_sha256", "string")],
    "op10_": [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")],
    "op12_": [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")],
    "op13_": [("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")],
}


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("start", COLUMNS)
def test_one_query_of_each_number_with_its_columns(spark, start):
    (name,) = [q for q in driver.queries() if q.startswith(start)]
    found = driver.queries()[name](spark, SF)
    assert found.dtypes == COLUMNS[start]
    table = "embeddings" if start == "op5_" else "documents"
    whole = spark.read.parquet(f"{SF}/{table}.parquet")
    key = found.columns[0]
    assert found.select(key).distinct().count() == whole.select(key).distinct().count()
    if start != "op3_":
        assert found.count() == whole.count()


def test_held_out_rows_follow_the_crc(spark):
    for name, rest in (("op1_quality_classifier", 0), ("op4_lm_scoring", 1)):
        for r in queries.QUERIES[name](spark, SF).select("doc_id", "held_out").collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == rest)


def test_fingerprints_of_the_query(spark):
    text = {r.doc_id: r.text for r in documents(spark).collect()}
    found = {r.doc_id: r for r in queries.QUERIES["op8_simhash"](spark, SF).collect()}
    ids, groups = sorted(text), Union(len(text))
    fps = [plain_fingerprint(text[i]) for i in ids]
    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                groups.join(a, b)
    for k, i in enumerate(ids):
        assert (found[i].fingerprint, found[i].component_id) == (f"{fps[k]:016x}", ids[groups.find(k)])


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives."""
    docs, out = documents(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, stage(spark, docs, SF).cache()
        out[name] = given, docs
    return out


def test_stages_return_the_columns_of_documents(spark, stages):
    assert list(stages) == ["quality_classifier", "line_dedup", "simhash", "mixing", "packing"]
    for name, (given, got) in list(stages.items())[:-1]:
        assert got.dtypes == documents(spark).dtypes, name
        assert 0 < got.count()


def test_quality_stage_drops_what_the_query_predicts(spark, stages):
    given, got = stages["quality_classifier"]
    predicted = {r.doc_id: r.predicted for r in queries.QUERIES["op1_quality_classifier"](spark, SF).collect()}
    assert {r.doc_id for r in got.collect()} == {i for i, p in predicted.items() if p}
    assert 0 < got.count() < given.count()


def test_line_stage(stages):
    given, got = stages["line_dedup"]
    want = plain_lines([(r.doc_id, r.text, r.source) for r in given.collect()])
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted((w[:2] for w in want), key=repr)
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_simhash_stage_keeps_one_of_each_group(stages):
    given, got = (sorted(map(tuple, x.collect())) for x in stages["simhash"])
    fps, groups = [plain_fingerprint(r[1]) for r in given], Union(len(given))
    for a in range(len(given)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                groups.join(a, b)
    assert got == [r for k, r in enumerate(given) if groups.find(k) == k]


def test_mixing_stage_takes_the_planned_copies(stages):
    given, got = stages["mixing"]
    times = {r.id: r.times for r in mixing.mixed(given).collect()}
    found = [r.doc_id for r in got.collect()]
    assert {i: found.count(i) for i in set(found)} == {i: n for i, n in times.items() if n}


def test_packing_stage_holds_every_id_once(stages):
    given, got = stages["packing"]
    pieces = sorted(got.collect(), key=lambda r: (r.sequence_id, r.offset))
    filled = {}
    for r in pieces:
        assert filled.get(r.sequence_id, 0) == r.offset and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        filled[r.sequence_id] = r.offset + r.length
    assert all(n == 2048 for k, n in filled.items() if k != max(filled))
    whole, docs = b"".join(r.ids for r in pieces), {r.doc_id: r.text for r in given.collect()}
    ids, at, seen = np.frombuffer(whole, "<u4"), 0, []
    ends = [k for k, r in enumerate(pieces) if r.start + r.length == r.doc_tokens]
    for k in ends:
        n = pieces[k].doc_tokens
        assert ids[at : at + n].tolist() == [*plain_ids(docs[pieces[k].doc_id]), 1]
        at, seen = at + n, [*seen, pieces[k].doc_id]
    assert at == len(ids) and sorted(seen) == sorted(r.doc_id for r in given.collect())


def test_run_gives_what_the_stages_give(spark, stages):
    want = stages["packing"][1].groupBy("doc_id").sum("length").collect()
    got = corpus_pipeline.run(spark, SF).groupBy("doc_id").sum("length").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
