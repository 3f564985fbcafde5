"""Sources mixed to target weights by capped water-filling.

Each source's target is its weight's share of all words, but at most
``most_epochs`` times what the source has. What a cap cuts off is shared out
again by weight among the others, until no target is above its cap. A source
then takes each of its documents the whole number of times that fits into the
target, and once more the documents that come first in a seeded order, up to
the one whose middle passes the target. So a source misses its target by half a
document at most, and a rerun takes the same documents.

That last document is found without sorting a source: words are summed by 4,096
ranges of the order, and only the range that the target falls into is sorted.

Null and empty texts have size 0. Null sources are one source, the last. Null
ids are ordered as empty text. Rows that share an id and a source are taken
together. Sources without words get target 0. An empty table gives no rows.
Further columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import WORD, Scratch, free, offsets_by_part, text_of

SEED = 7
WEIGHTS = (5, 2, 1)
PLAN = "__plan"


def place(id_col: str, seed: int) -> Column:
    """60 bits that order the documents: the leading hex digits of md5 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _weighed(sources: DataFrame, weights: tuple[float, ...], scratch: Scratch) -> DataFrame:
    """The weights repeat along the sources in order of code points, null last."""
    by = F.col("source").asc_nulls_last()
    ranged = sources.repartitionByRange(by).sortWithinPartitions(by).withColumn("at", F.monotonically_increasing_id())
    ranged = scratch.keep(ranged.select("*", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "sources")
    offsets = offsets_by_part(ranged.groupBy("part").count())
    start = F.create_map(*(F.lit(x).cast("long") for pair in offsets.items() for x in pair)) if offsets else F.create_map(F.lit(0).cast("long"), F.lit(0).cast("long"))
    weight = F.array(*(F.lit(float(w)) for w in weights))
    return ranged.select("source", "source_size", weight[((start[F.col("part")] + F.col("pos")) % len(weights)).cast("int")].alias("weight"))


def _level(weighed: DataFrame, most_epochs: float) -> float:
    """Words per unit of weight once no target is above its cap. A source is capped if level * weight > cap."""
    cap, level = F.lit(float(most_epochs)) * F.col("source_size"), None
    while True:
        capped = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        total, fixed, weight = weighed.agg(F.sum("source_size"), F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not weight:  # no source, or all of them capped
            return level or 0.0
        new = (float(total) - (fixed or 0.0)) / weight
        if level is not None and new <= level:
            return level
        level = new


def plan(sized: DataFrame, weights: tuple[float, ...], most_epochs: float, scratch: Scratch) -> DataFrame:
    """Per source: source_size, target, whole (times each document is taken) and last (place of the last document taken once more)."""
    weighed = scratch.keep(_weighed(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, scratch), "weighed")
    target = F.least(F.lit(_level(weighed, most_epochs)) * F.col("weight"), F.lit(float(most_epochs)) * F.col("source_size"))
    size = F.col("source_size")
    aimed = weighed.select("source", "source_size", target.alias("target"))
    aimed = aimed.withColumn("whole", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)).withColumn("need", F.col("target") - F.col("whole") * size)

    by_range = sized.groupBy("source", F.shiftright("place", 48).alias("range")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    by_range = by_range.withColumn("end", F.sum("words").over(running)).withColumn("begin", F.col("end") - F.col("words"))
    a, r = aimed.alias("a"), by_range.alias("r")
    edge = a.join(r, F.col("a.source").eqNullSafe(F.col("r.source")) & (F.col("r.begin") < F.col("a.need")) & (F.col("a.need") <= F.col("r.end"))).select("a.source", "r.range", "r.begin", "a.need")
    e, s = edge.alias("e"), sized.withColumn("range", F.shiftright("place", 48)).alias("s")
    near = s.join(e, F.col("s.source").eqNullSafe(F.col("e.source")) & (F.col("s.range") == F.col("e.range"))).groupBy("s.source", "s.place", "e.begin", "e.need").agg(F.sum("s.size").alias("words"))
    running = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("begin") + F.sum("words").over(running) - F.col("words") / 2
    taken = near.withColumn("middle", middle).where("middle < need").groupBy("source").agg(F.max("place").alias("last"))
    below = edge.select("source", (F.shiftleft("range", 48) - 1).alias("below"))
    out = aimed.alias("a").join(taken.alias("t"), F.col("a.source").eqNullSafe(F.col("t.source")), "left").join(below.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left")
    return scratch.keep(out.select("a.source", "a.source_size", "a.target", F.col("a.whole").cast("long"), F.coalesce("t.last", "b.below", F.lit(-1).cast("long")).alias("last")), "plan")


def _with_plan(rows: DataFrame, made: DataFrame, source: str) -> DataFrame:
    """Rows with the plan of their source as column ``plan``. The plan is stored, so Spark knows its size and broadcasts it
    if it is small; else adaptive execution splits the rows of a source that holds a third of them."""
    made = made.select(F.struct(*made.columns).alias(free(PLAN, rows.columns)), F.col("source").alias(free("__of", rows.columns)))
    return rows.join(made, F.col(source).eqNullSafe(F.col(free("__of", rows.columns))))


def sizes(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    size = F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), place(id_col, seed).alias("place"), size.alias("size"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: float = 3.0, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, size, source_size, target and times taken of every document."""
    scratch = Scratch(docs.sparkSession)
    sized = scratch.keep(sizes(docs, seed, id_col, text_col, source_col), "sized")
    rows = _with_plan(sized, plan(sized, weights, most_epochs, scratch), "source")
    times = F.col(PLAN)["whole"] + (F.col("place") <= F.col(PLAN)["last"]).cast("long")
    return rows.select("id", "size", F.col(PLAN)["source_size"].alias("source_size"), F.col(PLAN)["target"].alias("target"), times.alias("times"))


def repeated(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_epochs: float = 3.0, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document as many times as it is taken, columns unchanged."""
    scratch = Scratch(docs.sparkSession)
    made = plan(scratch.keep(sizes(docs, seed, id_col, text_col, source_col), "sized"), weights, most_epochs, scratch)
    taken = F.col(free(PLAN, docs.columns))
    times = (taken["whole"] + (place(id_col, seed) <= taken["last"]).cast("long")).cast("int")
    copies = _with_plan(docs, made, source_col).withColumn(free("__copy", docs.columns), F.explode(F.array_repeat(F.lit(1), times)))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])
