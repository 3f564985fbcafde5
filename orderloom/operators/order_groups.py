"""Join rows to their orders and attach order-level totals, orders of any size included.

An order passes or fails its filters as a whole and ``orders`` has one row per
``order_id``, so its totals need no join: they are a grouped aggregate of the
rows, combined in every task before it shuffles, and join the orders one to
one. What then joins the rows is one row per order, under a key of its own.
That key has an exchange of its own, so adaptive execution can split the rows
of a hot order among tasks. Each task joins its part with the same one row.

The price: with totals the rows are read twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "__order_key"


def join_orders(rows: DataFrame, orders: DataFrame, totals: Mapping[str, Column] | None = None) -> DataFrame:
    """Inner join on ``order_id``; ``totals`` are aggregates over the rows of an order.

    ``orders`` holds one row per ``order_id``, as its documented key says. Both
    inputs must be filtered already: totals see the rows that survived.
    """
    if totals:
        summed = rows.groupBy("order_id").agg(*[agg.alias(name) for name, agg in totals.items()])
        orders = orders.join(summed, "order_id")
    # A new expression: an order side that is already dealt by order_id would need no exchange, and without one nothing is split.
    keyed = orders.withColumn(_KEY, F.concat("order_id", F.lit(""))).drop("order_id")
    return rows.join(keyed, rows["order_id"] == F.col(_KEY)).drop(_KEY)


def deal(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by ``keys`` over as many partitions as the session's shuffles start from.

    Adaptive execution merges partitions up to a size on disk, and millions of short rows fit into that; it leaves
    partitions dealt by number as they are, so what a task holds shrinks as the session's shuffles widen.
    """
    conf = rows.sparkSession.conf
    width = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    return rows.repartition(int(width), *keys)
