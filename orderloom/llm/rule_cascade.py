"""Quality rules as a short-circuit cascade.

On a sample of documents each rule is timed alone and its rejections are
counted. The rules then run in the order of rejections per second, and a
document leaves at the first that rejects it. The order changes the time and
which rule is named, never the verdict.

A rule reads statistics of a text through ``Stats``, which works each out at
the first use and keeps it, so a rule that never runs costs nothing.

A null text counts as one without words. Rows are judged one by one, so
repeated rows get equal verdicts. Other columns are not read. An empty table
gives no rows, and the rules keep their given order.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.tokens import slices

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
NO_UPPER = bytes(range(65, 91))
#: Documents the sample has at most. It serves the order of the rules alone.
SAMPLE = 1_000


class Stats:
    """Of one text. Words are runs of bytes other than ASCII white space."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode()
        self.n_points = len(text or "")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words."""
        return self.n_points - len(self.raw) + len(self.raw.translate(None, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, NO_UPPER))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that hold a word."""
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a three-word window found twice or more, the first one included."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        times = Counter(windows)
        starts = np.array([times[x] > 1 for x in windows])
        inside = np.zeros(len(w), bool)
        for k in range(3):
            inside[k : k + len(starts)] |= starts
        return int(inside.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Stats], bool]


#: Limits are those common for web text; the first two are what every document must pass.
RULES = (
    Rule("too_few_words", lambda s: s.n_words < 50),
    Rule("repeated_windows", lambda s: 100 * s.n_repeat_words > 50 * s.n_words),
    Rule("symbols_per_word", lambda s: 10 * s.n_symbols > s.n_words),
    Rule("repeated_lines", lambda s: 10 * s.n_dup_lines > 3 * len(s.lines)),
    Rule("mean_word_length", lambda s: not 3 * s.n_words <= s.word_chars <= 12 * s.n_words),
    Rule("upper_case", lambda s: 2 * s.n_upper > s.word_chars),
)


@dataclass(frozen=True)
class Measured:
    rule: str
    seconds: float
    rejected: int
    seen: int

    @property
    def worth(self) -> float:
        """Rejections per second; a rule that rejects nothing comes last."""
        return self.rejected / max(self.seconds, 1e-9)


def _measure(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, seen = np.zeros(len(rules)), np.zeros(len(rules), np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += 1
                for k, rule in enumerate(rules):
                    stats, began = Stats(text), time.perf_counter()  # alone: nothing that another rule has worked out
                    rejected[k] += rule.rejects(stats)
                    seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "seconds": seconds, "rejected": rejected, "seen": [seen] * len(rules)})

    return run


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> list[Measured]:
    """Cost and rejections of each rule on ``sample`` documents, chosen by the hash of their id."""
    chosen = docs.select(F.xxhash64(F.col(id_col), F.lit(17)).alias("h")).orderBy("h").limit(sample)
    last = chosen.agg(F.max("h")).first()[0]
    some = docs.where(F.xxhash64(F.col(id_col), F.lit(17)) <= F.lit(last)).select(text_col).limit(sample)
    found = some.mapInArrow(_measure(rules), "rule string, seconds double, rejected long, seen long")
    by_rule = {r[0]: Measured(*r) for r in found.groupBy("rule").agg(F.sum("seconds"), F.sum("rejected"), F.sum("seen")).collect()}
    return [by_rule.get(r.name, Measured(r.name, 0.0, 0, 0)) for r in rules]


def order(rules: tuple[Rule, ...], measured: list[Measured]) -> tuple[Rule, ...]:
    worth = {m.rule: m.worth for m in measured}
    return tuple(sorted(rules, key=lambda r: -worth[r.name]))


def _judge(rules: tuple[Rule, ...], report: tuple[str, ...]):
    def verdict(stats: Stats) -> str | None:
        return next((r.name for r in rules if r.rejects(stats)), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(pc.binary_length(whole.column(1)).fill_null(0).to_pylist(), 16 << 20):
                failed, reported = [], []
                for text in whole.column(1).slice(a, b - a).to_pylist():
                    stats = Stats(text)
                    failed.append(verdict(stats))
                    reported.append([getattr(stats, c) for c in report])
                columns = [pa.array(c, pa.int64()) for c in zip(*reported, strict=True)]
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(a, b - a), pa.array(failed, pa.string()), *columns], names=["id", "failed", *report])

    return run


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, report: tuple[str, ...] = (), sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the rule that rejected the document (null: it passed them all), and the statistics asked for."""
    ordered = order(rules, measure(docs, rules, sample, id_col, text_col))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("failed", T.StringType()), *(T.StructField(c, T.LongType()) for c in report)])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_judge(ordered, report), schema)
