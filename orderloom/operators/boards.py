"""Wide daily board over the day summaries, one row per day that has any figure, and its cuts by role."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from orderloom.schemas import Table


def daily(calendar: DataFrame, *summaries: DataFrame) -> DataFrame:
    """The columns of every summary with those of the calendar; all inputs are at most one row per day."""
    days = reduce(lambda left, right: left.join(right, "date_id", "full"), summaries)
    return days.join(calendar.select("date_id", "year", "month", "is_weekend"), "date_id", "left")


def cut(board: DataFrame, role: Table) -> DataFrame:
    """The columns one role looks at."""
    return role.conform(board)
