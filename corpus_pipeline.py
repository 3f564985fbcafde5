"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet into the shared scratch folder and reads it back as the next
one's documents. All but the last return the columns of ``documents``.

Null and empty texts and ids, repeated rows, empty tables and further columns
are treated as the operator of each stage says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import line_dedup, mixing, packing, quality_classifier, simhash
from orderloom.llm.common import Scratch, free, remainder
from orderloom.llm.queries import QUALITY_LIMIT, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go. It learns from the labelled documents whose ids are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels, remainder(F.col("doc_id")) != 0)
    score = free(quality_classifier.SCORE, docs.columns)
    return quality_classifier.scored(docs, model).where(F.col(score) >= QUALITY_LIMIT).drop(score)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more found in five documents or more stay in one of them. The count of characters follows the text."""
    rows = line_dedup.drop_repeated_lines(docs, least_chars=40, least_docs=5)
    rows = rows.drop(free(line_dedup.LINES, docs.columns), free(line_dedup.DROPPED, docs.columns))
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 token ids, end id included."""
    found = packing.pieces(docs, tokenizer_path(), end_id=1)
    return found.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_lines),
    ("simhash", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
