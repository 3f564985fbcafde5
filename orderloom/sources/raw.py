"""Readers of the raw inputs: files with or without header, catalog and database tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.params import LoadWindow
from orderloom.schemas import Table
from orderloom.sources import quoted


def csv(spark: SparkSession, path: str, table: Table, line_breaks: bool = False) -> DataFrame:
    """A file with header, which must name the declared columns in order; doubled quotes stand for one.

    ``line_breaks`` is for text that spans lines, as review comments do: Spark
    alone reads such a file in one task, ``quoted`` reads it split by split.
    """
    if line_breaks:
        return quoted.read(spark, path, table)
    return spark.read.csv(path, schema=table.schema, header=True, enforceSchema=False, escape='"', mode="FAILFAST")


def headerless_csv(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """A file without header, columns ``col_1``, ``col_2``, ... in file order."""
    schema = T.StructType(
        [T.StructField(f"col_{n}", field.dataType) for n, field in enumerate(table.schema.fields, start=1)]
    )
    return spark.read.csv(path, schema=schema, header=False, escape='"', mode="FAILFAST")


def typed(rows: DataFrame, table: Table) -> DataFrame:
    """Parse the columns of any source, text included, to the declared types; what does not parse raises."""
    return rows.select(*[F.col(field.name).cast(field.dataType) for field in table.schema.fields])


def parquet(spark: SparkSession, path: str, table: Table) -> DataFrame:
    return typed(spark.read.parquet(path), table)


def catalog(spark: SparkSession, name: str, table: Table) -> DataFrame:
    """A table or view the session knows by name."""
    return typed(spark.read.table(name), table)


def _slices(cuts: list[str], time: str) -> list[str]:
    return [f"{time} >= '{low}' AND {time} < '{high}'" for low, high in zip(cuts, cuts[1:])]


def window_slices(window: LoadWindow, time: str, slices: int) -> list[str]:
    """The window cut into equal half-open ranges, one SQL predicate per parallel read."""
    start, end = datetime.fromisoformat(window.start), datetime.fromisoformat(window.end)
    return _slices([str(start + (end - start) * n / slices) for n in range(slices)] + [str(end)], time)


def depth_query(table: str, time: str, window: LoadWindow, slices: int) -> str:
    """Standard SQL for the source: the first time of each of ``slices`` parts that hold equally many rows of the window."""
    return (
        f"SELECT part, MIN({time}) AS low FROM (SELECT {time}, NTILE({slices}) OVER (ORDER BY {time}) AS part FROM {table}"
        f" WHERE {time} >= '{window.start}' AND {time} < '{window.end}') t GROUP BY part"
    )


def depth_slices(window: LoadWindow, time: str, lows: list[datetime]) -> list[str]:
    """The window cut where the parts begin, so that a day of many sales is read by many tasks. A part that begins
    at the same time as the one before, as where one instant has the rows of several parts, is read with it."""
    start, end = datetime.fromisoformat(window.start), datetime.fromisoformat(window.end)
    return _slices([str(start), *map(str, sorted(set(lows) - {start, min(lows, default=start)})), str(end)], time)


def jdbc_window(
    spark: SparkSession,
    url: str,
    table: str,
    declared: Table,
    time: str,
    window: LoadWindow,
    slices: int,
    properties: dict[str, str],
    equal_depth: bool = False,
) -> DataFrame:
    """The window of a database table, read by ``slices`` tasks that each fetch their own range.

    The ranges are equally long, or with ``equal_depth`` hold equally many rows: the source is asked first where they begin.
    """
    if equal_depth:
        lows = spark.read.jdbc(url, f"({depth_query(table, time, window, slices)}) cuts", properties=properties)
        predicates = depth_slices(window, time, [row["low"] for row in lows.collect()])  # one row a slice
    else:
        predicates = window_slices(window, time, slices)
    return typed(spark.read.jdbc(url, table, predicates=predicates, properties=properties), declared)
