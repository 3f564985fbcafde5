"""Snapshots of many days as the rows they have in common, each with the days it was there.

A full copy a day repeats what did not change. Here a row is stored once for
every unbroken run of snapshots that hold it (gaps and islands over the number
of the snapshot), so what is stored grows with the changes. A row that occurs
several times in a snapshot has as many intervals, and NULL is a value like any
other, so every snapshot can be read back as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import Table

FROM, TO = "valid_from", "valid_to"


def history_of(table: Table) -> Table:
    """The table of intervals: ``valid_to`` is the first snapshot without the row, null while it is there."""
    days = ((FROM, T.StringType(), "first snapshot with the row"), (TO, T.StringType(), "first one after it without the row"))
    return Table(f"{table.name}_history", f"{table.comment}, as intervals", table.key, (*table.columns, *days), dated=False)


def intervals(snapshots: DataFrame, table: Table, days: Sequence[str]) -> DataFrame:
    """``snapshots`` carry ``dt``; ``days`` are all their dates, also of a snapshot that has no rows."""
    days = sorted(days)
    place = F.create_map(*[F.lit(x) for n, dt in enumerate(days) for x in (dt, n)])
    after = F.create_map(*[F.lit(x) for n, dt in enumerate(days) for x in (n, dt)])
    counted = snapshots.groupBy(*table.names, "dt").agg(F.count(F.lit(1)).alias("__n"))
    # One row for each copy and snapshot; a window holds the snapshots of one of them, never more than there are days.
    copies = counted.select(*table.names, place[F.col("dt")].alias("__day"), F.explode(F.sequence(F.lit(1).cast("long"), "__n")).alias("__copy"))
    of_copy = Window.partitionBy(*table.names, "__copy").orderBy("__day")
    islands = copies.withColumn("__island", F.col("__day") - F.row_number().over(of_copy))
    found = islands.groupBy(*table.names, "__copy", "__island").agg(F.min("__day").alias("__first"), F.max("__day").alias("__last"))
    return found.select(*table.names, after[F.col("__first")].alias(FROM), F.when(F.col("__last") < len(days) - 1, after[F.col("__last") + 1]).alias(TO))


def as_of(history: DataFrame, table: Table, dt: str) -> DataFrame:
    """The snapshot of a day, as it was stored, from the intervals."""
    there = (F.col(FROM) <= dt) & (F.col(TO).isNull() | (F.col(TO) > dt))
    return history.where(there).select(*table.names)
