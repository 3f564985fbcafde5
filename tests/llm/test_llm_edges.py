"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and an empty table."""

import pytest
from cases import CLASHING, DOCS, documents, rows, with_more_columns
from pyspark.sql import functions as F

from orderloom.llm import embedding_dedup, filter_audit, importance, license_scan, line_dedup, lm_scoring, mixing, packing, quality_classifier, rule_cascade, simhash, suffix_dedup, token_files
from orderloom.llm.common import free
from orderloom.llm.queries import tokenizer_path

MODEL = quality_classifier.RuleEnsemble(0.5, (((quality_classifier.Split(0, True, 2.0),), 1.5),))
KEPT = ["doc_id", "text", "source"]

OPERATORS = {
    "classifier": lambda d: quality_classifier.scored(d, MODEL).select(*KEPT, free(quality_classifier.SCORE, d.columns)),
    "licences": license_scan.scan,
    "packing": lambda d: packing.pieces(d, tokenizer_path()).groupBy("id").agg(F.sum("length")),
    "lm": lambda d: lm_scoring.scored(d, F.col("doc_id") % 3 != 0).withColumns({c: F.round(c, 3) for c in ("base_score", "score")}),
    "cascade": lambda d: rule_cascade.judge(d, report=("n_words", "n_repeat_words")).select("id", F.col("failed").isNull(), "n_words", "n_repeat_words"),
    "mixing": mixing.mixed,
    "mixing_rows": lambda d: mixing.repeated(d).select(*KEPT),
    "simhash": simhash.near_duplicates,
    "simhash_rows": lambda d: simhash.keep_one(d).select(*KEPT),
    "lines": lambda d: line_dedup.drop_repeated_lines(d).select(*KEPT, free(line_dedup.LINES, d.columns), free(line_dedup.DROPPED, d.columns)),
    "files": lambda d: token_files.read(token_files.write(d, tokenizer_path()), d.schema["doc_id"].dataType),
    "audit": lambda d: filter_audit.failures(d, part_col="source"),
    "repeats": lambda d: suffix_dedup.cut_repeats(d, 40),
    "resampling": lambda d: importance.resample(d, d.select("text")),
}
ONE_EACH = ["classifier", "licences", "lm", "cascade", "mixing", "simhash", "lines", "files", "audit", "repeats", "resampling"]


@pytest.mark.parametrize("name", OPERATORS)
def test_more_columns_change_nothing_and_an_empty_table_gives_no_rows(spark, name):
    plain = rows(OPERATORS[name](documents(spark)))
    assert rows(OPERATORS[name](with_more_columns(documents(spark)))) == plain
    assert rows(OPERATORS[name](documents(spark, []))) == []
    if name in ONE_EACH:
        assert len(plain) == len(DOCS)


@pytest.mark.parametrize("name", ["classifier", "mixing_rows", "simhash_rows", "lines"])
def test_stages_keep_the_further_columns(spark, name):
    run = {
        "classifier": lambda d: quality_classifier.scored(d, MODEL).drop(free(quality_classifier.SCORE, d.columns)),
        "mixing_rows": mixing.repeated,
        "simhash_rows": simhash.keep_one,
        "lines": lambda d: line_dedup.drop_repeated_lines(d).drop(free(line_dedup.LINES, d.columns), free(line_dedup.DROPPED, d.columns)),
    }[name]
    docs = with_more_columns(documents(spark))
    out = run(docs)
    assert out.columns == docs.columns
    found = out.select(*CLASHING).distinct().collect()
    assert [tuple(r) for r in found] == [tuple(f"more {c}" for c in CLASHING)]


def test_only_unusable_rows(spark):
    nothing = documents(spark, [(None, None, None)] * 3)
    for name, run in OPERATORS.items():
        assert len(rows(run(nothing))) == {"packing": 1, "mixing_rows": 0, "simhash_rows": 1}.get(name, 3), name


def test_vectors_that_cannot_link(spark):
    given = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [3e38, 3e38]), (8, [1e-38, 1e-38]), (9, [1.0]), (9, [2.0]), (None, [1.0, 0.0])]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<float>").withColumn("cls", F.lit("x")).withColumn("v", F.lit(1))
    found = {(r.id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(vectors).collect()}
    alone = {(i, 0, i) for i in (1, 2, 3, 4, 5, 6, None)}
    assert found == alone | {(7, 1, 7), (8, 1, 7), (9, 1, 9)}
    assert rows(embedding_dedup.near_duplicates(vectors.limit(0))) == []
