"""Streams of raw rows, taken in by batches and carried on into the facts.

Every micro-batch is one write, filed under the batch's number: a batch that is
run again after a failure replaces itself, so it counts once. A row stands for
its key: rows of a key in a later batch take the place of those in an earlier
one. The daily load takes what stands now as its sources, finds the orders that
differ, and builds their facts as it does from any other source.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.params import LoadWindow
from orderloom.plans import loads
from orderloom.schemas import RAW, Table
from orderloom.sources.tables import Store


def _batches(table: Table) -> Table:
    return table.named(f"{table.name}_batches")


def take(store: Store, table: Table, rows: DataFrame, batch: int) -> None:
    """Keep the rows of a batch; the same batch again replaces them."""
    store.overwrite(_batches(table), rows, f"{batch:012d}")


def follow(streams: Mapping[str, DataFrame], store: Store, checkpoint: str) -> None:
    """Take in what the streams hold now and stop; ``streams`` by the short names of the raw tables."""
    running = []
    for name, stream in streams.items():
        writer = stream.writeStream.foreachBatch(lambda rows, batch, table=RAW[name]: take(store, table, rows, batch))
        running.append(writer.option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())
    for query in running:
        query.awaitTermination()


def standing(store: Store, table: Table) -> DataFrame:
    """Of every key the rows of the last batch that has it."""
    if not store.has(_batches(table)):
        return store.spark.createDataFrame([], table.schema)
    rows = store.read(_batches(table))
    last = rows.groupBy(*table.key).agg(F.max(F.col("dt").cast("long")).alias("__last"))
    last = last.withColumnsRenamed({k: f"__{k}" for k in table.key})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in table.key])
    # No batch of a key is later than its last; ">=" keeps the number out of the join's keys.
    return table.conform(rows.join(last, same & (F.col("dt").cast("long") >= F.col("__last"))))


def load_day(streams: Mapping[str, DataFrame], others: Mapping[str, DataFrame], store: Store, checkpoint: str, window: LoadWindow) -> None:
    """Take the streams in and load the day from what stands; ``others`` are the sources that are not streamed."""
    follow(streams, store, checkpoint)
    sources = dict(others) | {name: standing(store, RAW[name]) for name in streams}
    loads.daily_load(store, sources, window, copies=[name for name in loads.DAILY_COPIES if name not in streams])
