"""Raw layer: dated copies of the sources, no cleaning."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.params import LoadWindow
from orderloom.schemas import Table


def snapshot(source: DataFrame, table: Table, dt: str) -> DataFrame:
    """All rows of the source, stamped with the data date."""
    return table.conform(source).withColumn("dt", F.lit(dt))


def positional(source: DataFrame, table: Table) -> DataFrame:
    """Name the columns of a source without header by their position."""
    return source.toDF(*table.names)


def append_window(source: DataFrame, table: Table, time: str, window: LoadWindow) -> DataFrame:
    """Increment of a source that carries its own event time."""
    return snapshot(source.where(window.holds(time)), table, window.dt)


def changed(orders: DataFrame, table: Table, bought: str, milestones: tuple[str, ...], window: LoadWindow) -> DataFrame:
    """Orders bought before the window that reached one of the milestones in it."""
    reached = reduce(or_, (window.holds(time) for time in milestones))
    earlier = F.col(bought) < F.lit(window.start).cast("timestamp_ntz")
    return snapshot(orders.where(earlier & reached), table, window.dt)


def append_of_orders(source: DataFrame, table: Table, orders: DataFrame, dt: str) -> DataFrame:
    """Increment of a source without event time: the rows of the orders in their increment."""
    return snapshot(source.join(orders.select("order_id"), "order_id", "left_semi"), table, dt)
