"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Scratch


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of ``n`` nodes under the links a[i] - b[i]."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of the links (a, b); the component is its smallest node.

    Every step is written to the shared folder. Neighbours are never gathered:
    a step joins each link with the smallest neighbour of one end.
    """

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    step = 0
    now = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"links-{step}")
    before = None
    while (here := state(now)) != before:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(lowest, "a")
        small = met.select("a", F.col("m").alias("b")).unionByName(met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        step, before = step + 1, here
        now = scratch.keep(small.distinct(), f"links-{step}")
        if step > 1:
            scratch.remove(f"links-{step - 2}")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
