"""What differs between two states of the sources, and which stored rows are still true.

Only orders and reviews carry times; a cancellation, a new price or a payment
that comes late shows nowhere but in the rows themselves. So rows are compared
by hash, as multisets: how often a row occurs counts, and NULL keys and repeated
keys are keys like any other. Hashes are added up in two halves of 32 bits, which
combines before it shuffles and depends on no order of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import columns as c
from orderloom.operators import facts
from orderloom.params import LoadWindow
from orderloom.schemas import ORDER_STATE, RAW, Table

_NOW, _BEFORE = "now", "before"


def row_hash(*names: str) -> Column:
    """A NULL is hashed as such: a plain hash would skip it, and a value could move to the next column unseen."""
    return F.xxhash64(*[column for name in names for column in (F.col(name), F.col(name).isNull())])


def _sums(hashed: Column) -> tuple[Column, Column]:
    """Sums of the halves: they fit 64 bits for two billion rows of one key and more."""
    return F.sum(hashed.bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftrightunsigned(hashed, 32)).alias("high")


def _print() -> Column:
    return F.xxhash64("n", "low", "high")


def difference(old: DataFrame, new: DataFrame, table: Table) -> DataFrame:
    """Keys of the table whose rows were inserted, changed or removed from ``old`` to ``new``, with their numbers of rows."""
    keys, columns = list(table.key), table.names

    def printed(rows: DataFrame, name: str) -> DataFrame:
        low, high = _sums(row_hash(*columns))
        grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), low, high)
        return grouped.select(*keys, F.col("n").alias(f"n_{name}"), _print().alias(f"print_{name}")).alias(name)

    same = [F.col(f"{_BEFORE}.{k}").eqNullSafe(F.col(f"{_NOW}.{k}")) for k in keys]
    both = printed(old, _BEFORE).join(printed(new, _NOW), reduce(Column.__and__, same), "full")
    change = F.when(F.col("n_before").isNull(), "inserted").when(F.col("n_now").isNull(), "removed").otherwise("changed")
    # One side alone can hold a key of NULLs, so the side is told by its count and not by the key.
    key = [F.when(F.col("n_now").isNotNull(), F.col(f"{_NOW}.{k}")).otherwise(F.col(f"{_BEFORE}.{k}")).alias(k) for k in keys]
    return both.where(~F.col("print_before").eqNullSafe(F.col("print_now"))).select(
        *key,
        change.alias("change"),
        F.coalesce("n_before", F.lit(0).cast("long")).alias("rows_before"),
        F.coalesce("n_now", F.lit(0).cast("long")).alias("rows_now"),
    )


def surplus(rows: DataFrame, loaded: DataFrame, table: Table) -> DataFrame:
    """Rows of the source that occur more often than they were loaded, each as often as it is missing."""
    return table.conform(rows).exceptAll(table.conform(loaded))


def bundles(sources: Mapping[str, DataFrame], window: LoadWindow) -> DataFrame:
    """One row per order id of any source: what belongs to the order and a hash of it, as columns of ``ORDER_STATE``.

    Only what the window shows counts: an order bought after its end is there,
    but not bought; a review asked for after its end is not there.
    """
    bought, reviewed = window.holds(facts.PURCHASE), window.holds(facts.CREATION)

    def part(name: str, rows: DataFrame, day: Column, sound: Column, *more: Column) -> DataFrame:
        hashed = F.xxhash64(F.lit(name), row_hash(*RAW[name].names), *more)
        return rows.where(F.col("order_id").isNotNull()).select(
            "order_id", F.lit(name).alias("source"), day.cast("date").alias("on"), F.coalesce(sound, F.lit(False)).alias("sound"), hashed.alias("hash")
        )

    reviews = sources["reviews"].where(reviewed)
    rows = [
        part("orders", sources["orders"], F.when(bought, F.to_date(facts.PURCHASE)), bought & c.valid_status(), F.coalesce(bought, F.lit(False))),
        part("items", sources["items"], F.lit(None), facts.item_is_valid()),
        part("payments", sources["payments"], F.lit(None), F.lit(False)),
        part("reviews", reviews, F.to_date(facts.CREATION), F.lit(False)),
    ]
    of = lambda name: F.col("source") == name
    low, high = _sums(F.col("hash"))
    grouped = reduce(DataFrame.unionByName, rows).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"),
        low,
        high,
        F.max(F.when(of("orders"), F.col("on"))).alias("day"),
        F.min(F.when(of("reviews"), F.col("on"))).alias("first_review"),
        F.max(F.when(of("reviews"), F.col("on"))).alias("last_review"),
        F.max(of("orders") & F.col("sound")).alias("order_sound"),
        F.max(of("items") & F.col("sound")).alias("item_sound"),
        *[F.count_if(of(name)).alias(f"n_{name}") for name in ("orders", "items", "payments", "reviews")],
    )
    return grouped.withColumns({"print": _print(), "in_fact": F.col("order_sound") & F.col("item_sound")}).drop("n", "low", "high", "order_sound", "item_sound")


def newest(state: DataFrame, key: str) -> DataFrame:
    """Of every key the row of the latest load that has it. Over a table bucketed by the key this shuffles nothing."""
    dated = state.withColumn("loaded_on", F.to_date("dt"))
    last = dated.groupBy(key).agg(F.max("loaded_on").alias("last"))
    # No row is later than the last. Not "=", which would join by both columns and so shuffle both sides.
    return dated.join(last, key).where(F.col("loaded_on") >= F.col("last")).drop("loaded_on", "last")


def known(state: DataFrame) -> DataFrame:
    """The orders that are still there."""
    return newest(state, "order_id").where(F.col("change") != "removed")


_KEPT = [name for name in ORDER_STATE.names if f"{name}_before" in ORDER_STATE.names]


def touched(now: DataFrame, before: DataFrame, buckets: int, gone: bool = True, kept: bool = False) -> DataFrame:
    """``ORDER_STATE`` rows, customers aside, of the orders that differ between ``bundles`` and what is ``known``.

    ``gone``: an order that ``now`` lacks was removed; else ``now`` shows some orders only, and the others are as they
    were. ``kept``: orders that do not differ are listed too. The bundles are dealt into as many parts as the stored
    state has buckets, so that it is not shuffled.
    """
    new = now.repartition(buckets, "order_id").withColumn("is_new", F.lit(True))
    old = before.select("order_id", "print", *_KEPT).withColumnsRenamed({name: f"{name}_before" for name in ("print", *_KEPT)})
    both = new.join(old, "order_id", "full" if gone else "left")
    same = F.col("print").eqNullSafe(F.col("print_before"))
    change = F.when(same, "kept").when(F.col("print_before").isNull(), "inserted").when(F.col("is_new").isNull(), "removed").otherwise("changed")
    none = {f"n_{name}": F.coalesce(f"n_{name}", F.lit(0).cast("long")) for name in ("orders", "items", "payments", "reviews")}
    listed = both if kept else both.where(~same)
    return listed.withColumn("change", change).withColumns(none).withColumn("in_fact", F.coalesce("in_fact", F.lit(False))).drop("is_new", "print_before")


def current(fact: DataFrame, later: DataFrame) -> DataFrame:
    """The rows of a fact that no later load replaced; ``later`` holds the orders (order_id, dt) that loads found changed."""
    since = later.select(F.col("order_id").alias("__order"), F.col("dt").alias("__dt"))
    return fact.join(since, (F.col("order_id") == F.col("__order")) & (F.col("__dt") > F.col("dt")), "left_anti")
