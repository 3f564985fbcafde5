"""Feed of raw rows from a stream, for sources that publish them as they happen.

The stream lands in the same dated layout the batch loads read. Each row goes
to the day of its own event time, so a late row joins its day and no state or
watermark is kept; the file sink records what it committed, so a restart after
a failure neither loses nor repeats rows.

A feed is a table of its own: readers of a streamed folder see the files in the
sink's record only, and would not see what a batch load adds beside them. Increments
are cut from ``landed`` rows; ``facts`` carries streams on into the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.columns import day_id
from orderloom.schemas import Table
from orderloom.sources.tables import Store


#: Day of the rows that have no event time.
UNDATED = "unknown"


def _feed(table: Table) -> Table:
    return table.named(f"{table.name}_feed")


def land(stream: DataFrame, table: Table, time: str, store: Store, checkpoint: str) -> StreamingQuery:
    """Take in what the source holds now and stop; rows without event time land in the day ``unknown``."""
    rows = table.conform(stream).withColumn("dt", F.coalesce(day_id(time), F.lit(UNDATED)))
    return (
        rows.writeStream.format("orc")
        .option("compression", "snappy")
        .option("path", store.path(_feed(table)))
        .option("checkpointLocation", checkpoint)
        .partitionBy("dt")
        .trigger(availableNow=True)
        .start()
    )


def landed(store: Store, table: Table, dt: str | None = None) -> DataFrame:
    """Rows taken in so far, or those of one day."""
    return store.read(_feed(table), dt)
