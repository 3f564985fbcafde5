"""Quality classifier: a sparse ensemble of rules.

1. Statistics of each text (``FEATURES``; no label, language, source or id).
2. A random forest over the statistics of labelled texts. Every path from a
   root to a node is a rule, the conjunction of its splits.
3. A lasso logistic regression over the rules' 0/1 values keeps few of them.
4. The kept rules and their weights become one Spark column expression.

It is fitted on at most ``MOST_LABELLED`` labelled rows, chosen by the hash of
their id; scoring reads every row.

Null and empty texts have statistics of zero and are scored like any other.
Labels that are null or neither 0 nor 1 are not learnt from; each label row of
an id counts. Without labels of both kinds the score is the share of label 1,
and 0.5 without any. An empty table gives no rows. Other columns pass
unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_, eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Scratch, free
from orderloom.llm.tokens import slices

MOST_LABELLED = 20_000
FEATURES = (
    "log_words", "mean_word", "distinct_words", "same_as_previous", "symbols", "bars", "shouts", "stops",
    "commas", "digits", "upper", "other_punctuation", "non_ascii", "lines", "repeated_lines", "odd_words",
)
STATS = "__stats"
SCORE = "__score"


def _without(raw: bytes, gone: bytes) -> int:
    return len(raw) - len(raw.translate(None, gone))


def statistics(text: str | None) -> list[float]:
    """In the order of ``FEATURES``; shares are of words or of bytes."""
    raw = (text or "").encode()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(raw))
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        _without(raw, b"#*$%&<>") / n,
        raw.count(b"|") / n,
        _without(raw, b"!?") / n,
        raw.count(b".") / n,
        raw.count(b",") / n,
        _without(raw, b"0123456789") / size,
        _without(raw, bytes(range(65, 91))) / size,
        _without(raw, b"\"'()-/:;=@[\\]^_`{}~+") / n,
        (len(raw) - len(text or "")) / size,
        len(lines) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        sum(len(w) > 20 for w in words) / n,
    ]


def _add_statistics(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(pc.binary_length(whole.column(text_at)).fill_null(0).to_pylist(), 16 << 20):
                batch = whole.slice(a, b - a)
                found = np.array([statistics(t) for t in batch.column(text_at).to_pylist()])
                stats = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(FEATURES), pa.int32()), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, stats], names=[*batch.schema.names, STATS])

    return run


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema.fields), T.StructField(STATS, T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(_add_statistics(docs.columns.index(text_col)), schema)


@dataclass(frozen=True, order=True)
class Split:
    feature: int
    above: bool
    limit: float

    def column(self) -> Column:
        value = F.col(STATS)[self.feature]
        return value > F.lit(self.limit) if self.above else value <= F.lit(self.limit)

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.limit:.4g}"


Path = tuple[Split, ...]


def holds(path: Path) -> Column:
    return reduce(and_, (s.column() for s in path))


def tree_paths(node, path: Path = ()) -> set[Path]:
    """The conjunctions that lead to each node below ``node``, a node of Spark's fitted trees. Of splits of one feature in one direction the narrowest stays."""
    narrow: dict[tuple[int, bool], float] = {}
    for s in path:
        key = (s.feature, s.above)
        narrow[key] = s.limit if key not in narrow else (max if s.above else min)(narrow[key], s.limit)
    found = {tuple(sorted(Split(f, above, limit) for (f, above), limit in narrow.items()))} if path else set()
    if node.subtreeDepth() == 0:
        return found
    split = node.split()
    feature, limit = split.featureIndex(), split.threshold()
    left = tree_paths(node.leftChild(), (*path, Split(feature, False, limit)))
    return found | left | tree_paths(node.rightChild(), (*path, Split(feature, True, limit)))


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Path, float], ...] = ()

    def score(self) -> Column:
        """Of a table with the column of statistics."""
        total = F.lit(self.intercept)
        for path, weight in self.rules:
            total = total + F.when(holds(path), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def __str__(self) -> str:
        return "\n".join([f"{self.intercept:+.3f}", *(f"{w:+.3f} if {' and '.join(map(str, p))}" for p, w in self.rules)])


def _logit(share: float) -> float:
    return float(np.log(share / (1 - share)))


def fit(labelled: DataFrame, trees: int = 24, depth: int = 3, lasso: float = 0.0005, seed: int = 11) -> RuleEnsemble:
    """From rows with the column of statistics and ``label`` (0.0 or 1.0)."""
    # Here, as the workers that compute statistics load this module too and have no use for 40 MB of it each.
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    n, ones = labelled.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0.0, float(n)):
        return RuleEnsemble(_logit((float(ones or 0) + 1) / (n + 2)))
    rows = labelled.select("label", F.col(STATS), array_to_vector(STATS).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=seed).fit(rows)
    paths = sorted(set().union(*(tree_paths(t._call_java("rootNode")) for t in forest.trees)))
    if not paths:
        return RuleEnsemble(_logit(float(ones) / n))
    fired = rows.select("label", array_to_vector(F.array(*(F.when(holds(p), 1.0).otherwise(0.0) for p in paths))).alias("features"))
    lasso_model = LogisticRegression(regParam=lasso, elasticNetParam=1.0, maxIter=60).fit(fired)
    weights = zip(paths, lasso_model.coefficients.toArray().tolist(), strict=True)
    return RuleEnsemble(float(lasso_model.intercept), tuple((p, w) for p, w in weights if w))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most: int = MOST_LABELLED, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> RuleEnsemble:
    """Fit on labelled documents; ``usable`` says which rows of ``labels`` may be learnt from."""
    scratch = Scratch(docs.sparkSession)
    good = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    good = (good if usable is None else good.where(usable)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("label"))
    chosen = good.orderBy(F.xxhash64("__id"), "__id", "label").limit(most)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col)).join(F.broadcast(chosen), "__id")
    return fit(scratch.keep(with_statistics(texts, text_col).select("label", STATS), "labelled").coalesce(4))


def scored(docs: DataFrame, model: RuleEnsemble, text_col: str = "text") -> DataFrame:
    """The documents with the column ``SCORE``, 0 to 1; where they have one of that name, ``free`` gives the name."""
    own = {c: free(f"kept{c}", docs.columns) for c in docs.columns if c.lower() in (SCORE, STATS)}
    found = with_statistics(docs.withColumnsRenamed(own), text_col).withColumn(SCORE, model.score()).drop(STATS)
    return found.withColumnsRenamed({SCORE: free(SCORE, docs.columns)}).withColumnsRenamed({new: old for old, new in own.items()})
