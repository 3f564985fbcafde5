"""Run parameters of a load: a half-open time window and the target partition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoadWindow:
    """Rows with ``start <= time < end`` are loaded into partition ``dt``."""

    start: str
    end: str
    dt: str

    def holds(self, time: str | Column) -> Column:
        # Literals are typed like the column, so the predicate needs no cast of
        # the column and can be pushed into the file scan.
        time = F.col(time) if isinstance(time, str) else time
        lower = F.lit(self.start).cast("timestamp_ntz")
        upper = F.lit(self.end).cast("timestamp_ntz")
        return (time >= lower) & (time < upper)


@dataclass(frozen=True)
class Select:
    """Which fact rows a summary reads: a time window, one ``dt`` partition, or all rows given."""

    window: LoadWindow | None = None
    dt: str | None = None

    @classmethod
    def between(cls, window: LoadWindow) -> Select:
        return cls(window=window)

    @classmethod
    def all(cls) -> Select:
        return cls()

    @classmethod
    def partition(cls, dt: str) -> Select:
        return cls(dt=dt)

    def by_time(self, rows: DataFrame, time: str) -> DataFrame:
        """Window mode only; partition mode leaves ``rows`` as they are."""
        return rows.where(self.window.holds(time)) if self.window else rows

    def by_partition(self, rows: DataFrame) -> DataFrame:
        """Partition mode only; window mode leaves ``rows`` as they are."""
        return rows.where(F.col("dt") == self.dt) if self.dt else rows

    def __call__(self, rows: DataFrame, time: str) -> DataFrame:
        return self.by_partition(self.by_time(rows, time))
