"""Full and daily load: every layer reads what the layer below has written.

Each table is one write. Nothing is kept in memory between layers, so a lost
executor costs the tasks it ran and a failed load can be run again.

A full load computes every table from all history into one ``dt``. A daily load
brings the store up to the sources: it compares what belongs to each order
(its own row, items, payments, reviews) with what the loads before found, and
loads anew, whole, the orders that differ, be they new, late, changed,
cancelled or gone. Every load lists these orders in ``ORDER_STATE``; rows of a
fact are true as long as no later load lists their order. The days of those
orders, and the first days of their customers, are summed up again, so that the
newest row of each day is the one a full load of the same sources would give.

What a daily load shuffles is the sources' rows by order, combined before they
move, and the day's own rows. Earlier loads are not shuffled: the state lies in
buckets of orders, facts are read by the months of the days in question.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas as s
from orderloom.functions import columns as c
from orderloom.operators import boards, changes, dims, facts, history, ods, quality, summaries
from orderloom.params import LoadWindow, Select
from orderloom.sources.tables import Store

BOARD_PARTS = (s.SUM_ORDER_BY_DATE, s.SUM_STATUS_BY_DATE, s.SUM_PAYMENT_BY_DATE, s.SUM_REVIEW_BY_DATE)

# Raw tables that belong to orders, with the increment table that takes the rows of the orders a load found changed.
INCREMENTS = {
    "orders": s.ORDERS.named("ods_orders_di"),
    "items": s.ITEMS.named("ods_items_di"),
    "payments": s.PAYMENTS.named("ods_payments_di"),
    "reviews": s.REVIEWS.named("ods_reviews_di"),
}

# The sources a daily load copies whole unless told otherwise: those its own steps read.
DAILY_COPIES = ("customers", "sellers", "products", "translation", "orders")


def snapshots(store: Store, sources: Mapping[str, DataFrame], dt: str) -> None:
    for name, rows in sources.items():
        store.overwrite(s.RAW[name], rows, dt)


def dimensions(store: Store, products: DataFrame, translation: DataFrame, customers: DataFrame, sellers: DataFrame, dt: str) -> None:
    store.overwrite(s.DIM_PRODUCT, dims.product(products, translation), dt)
    store.overwrite(s.DIM_CUSTOMER, dims.customer(customers), dt)
    store.overwrite(s.DIM_SELLER, dims.seller(sellers), dt)


def calendar(store: Store, dt: str) -> None:
    store.replace(s.DIM_DATE, dims.date(store.read(s.ORDERS, dt)))


def _by_key(store: Store, fact: DataFrame, select: Select, dt: str, history: DataFrame | None) -> None:
    """The order summaries that have no day among their keys."""
    products = store.read(s.DIM_PRODUCT, dt)
    customers, sellers = store.read(s.DIM_CUSTOMER, dt), store.read(s.DIM_SELLER, dt)
    by_category = summaries.order_by_category(fact, products, select, first_purchase=history)
    store.overwrite(s.SUM_ORDER_BY_CATEGORY, by_category, dt)
    store.overwrite(s.SUM_ORDER_BY_CUSTOMER_REGION, summaries.order_by_customer_region(fact, customers, select), dt)
    by_seller = summaries.order_by_seller_region(fact, sellers, select, first_purchase=history)
    store.overwrite(s.SUM_ORDER_BY_SELLER_REGION, by_seller, dt)


def _boards(store: Store, dt: str) -> None:
    whole = board(store, dt)
    for table in s.BOARDS:
        store.overwrite(table, boards.cut(whole, table), dt)


def _log(store: Store, window: LoadWindow, whole: bool) -> tuple[LoadWindow, str, str | None]:
    """Note the load; returns the window that the store covers with it, the oldest ``dt`` in it and the newest before."""
    day = store.spark.createDataFrame([(window.start, window.end, whole)], s.LOADS.schema)
    store.overwrite(s.LOADS, day, window.dt)
    loads = store.read(s.LOADS).where(F.col("dt") <= window.dt)
    start, oldest, before = loads.agg(F.min("start"), F.min("dt"), F.max(F.when(F.col("dt") < window.dt, F.col("dt")))).first()
    return LoadWindow(start, window.end, window.dt), oldest, before


def _remember(store: Store, changes: DataFrame, orders: DataFrame, dt: str) -> None:
    """Keep the changed orders with their customers, and the first days of these customers."""
    customers = orders.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.max("customer_id").alias("customer_id"))
    store.overwrite(s.ORDER_STATE, changes.drop("customer_id", "dt").join(customers, "order_id", "left"), dt)
    changed = store.read(s.ORDER_STATE, dt)
    people = changed.select("customer_id").union(changed.select("customer_id_before")).where(F.col("customer_id").isNotNull()).distinct()
    sold = state(store, dt).where("in_fact").join(people, "customer_id", "left_semi")
    first = sold.groupBy("customer_id").agg(F.min("day").alias("first_day"))
    store.overwrite(s.FIRST_PURCHASE, people.join(first, "customer_id", "left"), dt)


def state(store: Store, dt: str) -> DataFrame:
    """All orders as the loads up to ``dt`` found them last."""
    return changes.known(store.read(s.ORDER_STATE).where(F.col("dt") <= dt))


def first_days(store: Store, dt: str) -> DataFrame:
    """First day of every customer as the loads up to ``dt`` found it last."""
    return changes.newest(store.read(s.FIRST_PURCHASE).where(F.col("dt") <= dt), "customer_id").select("customer_id", "first_day")


def _duplicates(store: Store, raw: Mapping[str, DataFrame], changed: DataFrame, dt: str, oldest: str) -> None:
    """Repeated keys of all rows. Keys lie within an order, so only changed orders are grouped again."""
    by_order = {name: raw[name] for name in INCREMENTS}
    of_changed = {name: rows.join(changed.select("order_id"), "order_id", "left_semi") for name, rows in by_order.items()}
    store.overwrite(s.DUPLICATE_STATE, quality.all_duplicate_keys(of_changed, "order_id"), dt)
    standing = changes.current(store.read(s.DUPLICATE_STATE).where(F.col("dt") <= dt), _later(store, dt, oldest))
    nobody = {name: rows.where(F.col("order_id").isNull()) for name, rows in by_order.items()}
    others = {name: rows for name, rows in raw.items() if name not in by_order}
    found = quality.all_duplicate_keys(nobody).unionByName(quality.all_duplicate_keys(others))
    store.overwrite(s.QUALITY_DUPLICATES, standing.select(*s.QUALITY_DUPLICATES.names).unionByName(found), dt)


def full_load(store: Store, sources: Mapping[str, DataFrame], window: LoadWindow) -> None:
    """All history into partition ``window.dt`` of every table."""
    dt = window.dt
    _, oldest, before = _log(store, window, True)
    snapshots(store, sources, dt)
    raw = {name: store.read(s.RAW[name], dt) for name in sources}
    dimensions(store, raw["products"], raw["translation"], raw["customers"], raw["sellers"], dt)
    calendar(store, dt)
    store.overwrite(s.FACT_ORDER, facts.order(raw["orders"], raw["items"], window), dt)
    store.overwrite(s.FACT_PAYMENT, facts.payment(raw["payments"], raw["orders"], window), dt)
    store.overwrite(s.FACT_REVIEW, facts.review(raw["reviews"], raw["orders"], window), dt)
    store.overwrite(s.ORDER_CHANGES, changes.touched(changes.bundles(raw, window), _known_before(store, before), store.buckets, kept=True), dt)
    _remember(store, store.read(s.ORDER_CHANGES, dt), raw["orders"], dt)
    # Other loads have partitions of their own; reading them too would count their orders again.
    fact, payments, reviews = (store.read(t, dt) for t in (s.FACT_ORDER, s.FACT_PAYMENT, s.FACT_REVIEW))
    select = Select.between(window)
    by_date = {
        s.SUM_STATUS_BY_DATE: summaries.order_status_by_date(raw["orders"], select),
        s.SUM_ORDER_BY_DATE: summaries.order_by_date(fact, select),
        s.SUM_PAYMENT_BY_DATE: summaries.payment_by_date(payments, fact, select),
        s.SUM_REVIEW_BY_DATE: summaries.review_by_date(reviews, fact, select),
    }
    for table, rows in by_date.items():
        if before is not None and store.has(table):
            earlier = store.read(table).where(F.col("dt") < dt).select("date_id").distinct().withColumn("had_rows", F.lit(True))
            rows = _with_emptied(table, rows, earlier)
        store.overwrite(table, rows, dt)
    _by_key(store, fact, select, dt, None)
    store.overwrite(s.QUALITY_RULES, quality.rules_report(raw["orders"], raw["items"], raw["payments"], raw["reviews"]), dt)
    _rejected(store, raw, dt)
    _duplicates(store, raw, store.read(s.ORDER_CHANGES, dt), dt, oldest)
    _boards(store, dt)


def _rejected(store: Store, raw: Mapping[str, DataFrame], dt: str) -> None:
    """Keep the rows that no fact takes with the rules they break: of all rows by a full load, of the changed orders and of no order by a daily one."""
    for name, table in s.REJECTED.items():
        _, rejected = quality.split(raw[name], name)
        store.overwrite(table, rejected, dt)


def _known_before(store: Store, before: str | None) -> DataFrame:
    if before is None or not store.has(s.ORDER_STATE):
        return store.spark.createDataFrame([], s.ORDER_STATE.stored)
    return state(store, before)


def _moved(raw: Mapping[str, DataFrame], window: LoadWindow) -> dict[str, DataFrame]:
    """The rows of the orders that were bought, reached a milestone or were reviewed in the window."""
    orders, reviews = raw["orders"], raw["reviews"]
    moved = orders.where(window.holds(facts.PURCHASE)).select("order_id").unionByName(
        ods.changed(orders, s.ORDERS, facts.PURCHASE, facts.MILESTONES, window).select("order_id")
    ).unionByName(reviews.where(window.holds(facts.CREATION) | window.holds("review_answer_timestamp")).select("order_id"))
    ids = moved.where(F.col("order_id").isNotNull()).distinct()
    return {name: raw[name].join(ids, "order_id", "left_semi") for name in INCREMENTS}


def increments(store: Store, sources: Mapping[str, DataFrame], changed: DataFrame, window: LoadWindow, append: bool) -> dict[str, DataFrame]:
    """Store the rows of the changed orders; returns those of this run, not what earlier runs appended."""
    dt, taken = window.dt, {}
    shown = changed.where(F.col("day").isNotNull() | F.col("first_review").isNotNull())
    for name, table in INCREMENTS.items():
        rows = sources[name].where(window.holds(facts.CREATION)) if name == "reviews" else sources[name]
        rows = ods.append_of_orders(rows, s.RAW[name], shown, dt)
        (store.append if append else store.overwrite)(table, rows, dt)
        # The stored increment, not the filtered source: its true size lets Spark
        # filter the other sources where they are read instead of shuffling them.
        taken[name] = rows if append else store.read(table, dt)
    return taken


def _touched_days(store: Store, dt: str, before: str | None) -> None:
    """Days on which an order, a customer's first order or a review was, or is now."""
    changed = store.read(s.ORDER_STATE, dt)

    def days(source: str, on: str, had: Column) -> DataFrame:
        return changed.where(F.col(on).isNotNull()).select(F.lit(source).alias("source"), F.col(on).alias("on"), had.alias("had_rows"))

    def span(first: str, last: str, had: Column) -> DataFrame:
        """An order of two reviews has two days; of one with more, every day between counts."""
        several = F.when(F.col("n_reviews") > 2, F.sequence(first, last)).otherwise(F.array_distinct(F.array(first, last)))
        every = F.sequence(first, last) if first.endswith("before") else several
        return changed.where(F.col(first).isNotNull()).select(F.lit("reviews").alias("source"), F.explode(every).alias("on"), had.alias("had_rows"))

    found = [
        days("orders", "day", F.lit(False)),
        days("orders", "day_before", F.lit(True)),
        span("first_review", "last_review", F.lit(False)),
        span("first_review_before", "last_review_before", F.coalesce("in_fact_before", F.lit(False))),
    ]
    if before is not None and store.has(s.FIRST_PURCHASE):
        now = store.read(s.FIRST_PURCHASE, dt).select("customer_id", F.col("first_day").alias("first_now"))
        moved = now.join(first_days(store, before), "customer_id").where(~F.col("first_now").eqNullSafe(F.col("first_day")))
        both = moved.select(F.explode(F.array("first_now", "first_day")).alias("on")).where(F.col("on").isNotNull())
        found.append(both.select(F.lit("orders").alias("source"), "on", F.lit(False).alias("had_rows")))
    touched = reduce(DataFrame.unionByName, found).groupBy("source", "on").agg(F.max("had_rows").alias("had_rows"))
    store.overwrite(s.TOUCHED_DAYS, touched.withColumn("date_id", F.col("on").cast("string")), dt)


def _later(store: Store, dt: str, oldest: str) -> DataFrame:
    """Orders that loads up to ``dt`` found changed. No row is older than the oldest load, so its own list is not read."""
    return store.read(s.ORDER_STATE).where((F.col("dt") > oldest) & (F.col("dt") <= dt)).select("order_id", "dt")


def _rows_of_days(store: Store, table: s.Table, days: DataFrame, dt: str, oldest: str) -> DataFrame:
    """The rows of a fact on these days that are true after the load of ``dt``; only the months of the days are read."""
    months = [row[0] for row in days.select(F.substring("date_id", 1, 7)).distinct().collect()]
    rows = store.read(table, months=months).where(F.col("dt") <= dt).join(days.select("date_id"), "date_id", "left_semi")
    return changes.current(rows, _later(store, dt, oldest))


def _with_emptied(table: s.Table, rows: DataFrame, days: DataFrame) -> DataFrame:
    """A day that had rows and has none left gets one that counts 0, so that it replaces the earlier row."""
    first, *counts = [name for name, kind, _ in table.columns if kind == T.LongType()]
    both = days.select("date_id", "had_rows").join(rows, "date_id", "full").where(F.col(first).isNotNull() | F.col("had_rows"))
    return both.withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in (first, *counts)})


def _exist(store: Store, rows: DataFrame, dt: str) -> DataFrame:
    """Of the orders of some rows those that the order fact has; dealt like the state, which stays where it lies."""
    ids = rows.select("order_id").distinct().repartition(store.buckets, "order_id")
    return ids.join(state(store, dt).where("in_fact").select("order_id"), "order_id")  # one row each; a semi-join would move below the dealing


def daily_load(
    store: Store,
    sources: Mapping[str, DataFrame],
    window: LoadWindow,
    append: bool = False,
    copies: Collection[str] = DAILY_COPIES,
    reconcile: bool = True,
) -> None:
    """One day of events, and all that changed since the loads before, into partition ``window.dt``.

    By default the day is replaced, so a repeated run changes nothing;
    ``append=True`` adds the rows of this run to the increments and facts
    instead, so two runs leave two copies of each row. ``copies`` names the
    sources whose full snapshot is stored; steps read the snapshot where there
    is one, else the source. ``reconcile=False`` looks only at the orders that
    were bought, reached a milestone or were reviewed in the window: that reads
    a day and not the whole sources, and misses what changes without a time,
    until a load reconciles.
    """
    dt = window.dt
    write = store.append if append else store.overwrite
    scope, oldest, before = _log(store, window, False)
    snapshots(store, {name: rows for name, rows in sources.items() if name in copies}, dt)
    raw = {name: store.read(s.RAW[name], dt) if name in copies else rows for name, rows in sources.items()}
    dimensions(store, raw["products"], raw["translation"], raw["customers"], raw["sellers"], dt)
    store.replace(s.DIM_DATE, dims.date(raw["orders"]))

    now = changes.bundles(raw if reconcile else _moved(raw, window), scope)
    store.overwrite(s.ORDER_CHANGES, changes.touched(now, _known_before(store, before), store.buckets, gone=reconcile), dt)
    changed = store.read(s.ORDER_CHANGES, dt)
    taken = increments(store, raw, changed, scope, append)
    write(s.FACT_ORDER, facts.order(taken["orders"], taken["items"], scope), dt)
    write(s.FACT_PAYMENT, facts.payment(taken["payments"], taken["orders"], scope), dt)
    write(s.FACT_REVIEW, facts.review(taken["reviews"], taken["orders"], scope), dt)
    _remember(store, changed, taken["orders"], dt)
    _touched_days(store, dt, before)

    days = store.read(s.TOUCHED_DAYS, dt)
    of_orders, of_reviews = days.where("source = 'orders'"), days.where("source = 'reviews'")
    customers, every = first_days(store, dt), Select.all()
    fact = _rows_of_days(store, s.FACT_ORDER, of_orders, dt, oldest)
    payments = _rows_of_days(store, s.FACT_PAYMENT, of_orders, dt, oldest)
    reviews = _rows_of_days(store, s.FACT_REVIEW, of_reviews, dt, oldest)
    orders = raw["orders"].where(scope.holds(facts.PURCHASE))
    orders = orders.join(of_orders.select("date_id"), c.day_id(facts.PURCHASE) == F.col("date_id"), "left_semi")
    by_date = {
        s.SUM_STATUS_BY_DATE: (summaries.order_status_by_date(orders, every), of_orders),
        s.SUM_ORDER_BY_DATE: (summaries.order_by_date(fact, every, customers), of_orders),
        s.SUM_PAYMENT_BY_DATE: (summaries.payment_by_date(payments, fact, every), of_orders),
        s.SUM_REVIEW_BY_DATE: (summaries.review_by_date(reviews, _exist(store, reviews, dt), every), of_reviews),
    }
    for table, (rows, touched) in by_date.items():
        store.overwrite(table, _with_emptied(table, rows, touched), dt)

    new = store.read(s.FACT_ORDER, dt).where(window.holds(facts.PURCHASE))
    _by_key(store, new, Select.partition(dt), dt, customers)
    _rejected(store, {name: rows.drop("dt").unionByName(s.RAW[name].conform(raw[name].where(F.col("order_id").isNull()))) for name, rows in taken.items()}, dt)
    rules = quality.rules_report(raw["orders"], raw["items"], raw["payments"], raw["reviews"])
    late = [quality.late_rows(changed, name) for name in ("payments", "items")]
    store.overwrite(s.QUALITY_RULES, reduce(DataFrame.unionByName, late, rules), dt)
    _duplicates(store, raw, changed, dt, oldest)
    _boards(store, dt)


def keep_as_intervals(store: Store, table: s.Table, days: Collection[str]) -> None:
    """The snapshots of these days as intervals, from which ``history.as_of`` reads any of them; the copies can then go."""
    rows = store.read(table).where(F.col("dt").isin(*days))
    store.replace(history.history_of(table), history.intervals(rows, table, days))


def latest_facts(store: Store, table: s.Table, dt: str) -> DataFrame:
    """All rows of a fact that are true after the load of ``dt``."""
    oldest = store.read(s.LOADS).agg(F.min("dt")).first()[0]
    return changes.current(store.read(table).where(F.col("dt") <= dt), _later(store, dt, oldest))


def latest_by_day(summary: DataFrame) -> DataFrame:
    """Of every day the row of the newest load that touched it; days that were emptied have none."""
    newest = summary.groupBy("date_id").agg(F.max("dt").alias("dt"))
    rows = summary.join(newest, ["date_id", "dt"], "left_semi").drop("dt")
    first = next(f.name for f in rows.schema.fields if f.dataType == T.LongType())
    return rows.where(F.col(first) > 0)


def board(store: Store, dt: str) -> DataFrame:
    days = [store.read(part, dt).drop("dt") for part in BOARD_PARTS]
    return boards.daily(store.read(s.DIM_DATE), *days)


def quality_report(store: Store, dt: str) -> DataFrame:
    """What the load of ``dt`` found, as stored."""
    return store.read(s.QUALITY_RULES, dt).drop("dt")
