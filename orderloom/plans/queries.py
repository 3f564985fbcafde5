"""Registered queries: every builder and rule, run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas as s
from orderloom.functions import columns as c
from orderloom.operators import boards, changes, dims, facts, history, ods, quality, summaries
from orderloom.params import LoadWindow, Select
from orderloom.sources.bindings import headerless_translation, raw, state
from orderloom.sources.tables import scratch_store

FULL = LoadWindow("1995-01-01", "2002-01-01", "2002-01-01")
MONTH = LoadWindow("1998-06-01", "1998-07-01", "1998-07-01")
DAY = "1998-06-15"
EARLIER_DT, LATER_DT = "2001-12-31", "2002-01-01"

ALL = Select.between(FULL)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def present(rows: DataFrame) -> DataFrame:
    """Comparable output: decimals as doubles, times and dates as text."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.TimestampNTZType, T.DateType)):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return rows.select(*columns)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: present(run(spark, sf_dir))
    return run


def _fact(spark: SparkSession, sf_dir: str, window: LoadWindow = FULL) -> DataFrame:
    return facts.order(raw(spark, sf_dir, "orders"), raw(spark, sf_dir, "items"), window)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_lines(raw(spark, sf_dir, "orders"), raw(spark, sf_dir, "items"), FULL)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_sums(raw(spark, sf_dir, "orders"), raw(spark, sf_dir, "items"), FULL)


def _payments(spark: SparkSession, sf_dir: str, window: LoadWindow = FULL) -> DataFrame:
    return facts.payment(raw(spark, sf_dir, "payments"), raw(spark, sf_dir, "orders"), window)


def _reviews(spark: SparkSession, sf_dir: str, window: LoadWindow = FULL) -> DataFrame:
    return facts.review(raw(spark, sf_dir, "reviews"), raw(spark, sf_dir, "orders"), window)


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.product(raw(spark, sf_dir, "products"), raw(spark, sf_dir, "translation"))


# --- raw snapshots ----------------------------------------------------------


def _snapshot(name: str) -> Query:
    return lambda spark, sf_dir: present(ods.snapshot(raw(spark, sf_dir, name), s.RAW[name], FULL.dt))


for _name in ("orders", "customers", "payments", "reviews", "items", "sellers", "geolocation", "products"):
    QUERIES[f"ods_{_name}"] = _snapshot(_name)


@query
def ods_category_translation(spark, sf_dir):
    source = headerless_translation(spark, sf_dir)
    return ods.snapshot(ods.positional(source, s.TRANSLATION), s.TRANSLATION, FULL.dt)


@query
def ods_orders_increment(spark, sf_dir):
    return ods.append_window(raw(spark, sf_dir, "orders"), s.ORDERS, facts.PURCHASE, MONTH)


@query
def ods_items_increment(spark, sf_dir):
    return ods.append_of_orders(raw(spark, sf_dir, "items"), s.ITEMS, ods_orders_increment(spark, sf_dir), MONTH.dt)


@query
def ods_payments_increment(spark, sf_dir):
    orders = ods_orders_increment(spark, sf_dir)
    return ods.append_of_orders(raw(spark, sf_dir, "payments"), s.PAYMENTS, orders, MONTH.dt)


@query
def ods_reviews_increment(spark, sf_dir):
    return ods.append_window(raw(spark, sf_dir, "reviews"), s.REVIEWS, facts.CREATION, MONTH)


# --- dimensions -------------------------------------------------------------


@query
def dim_product(spark, sf_dir):
    return _products(spark, sf_dir)


@query
def dim_customer(spark, sf_dir):
    return dims.customer(raw(spark, sf_dir, "customers"))


@query
def dim_seller(spark, sf_dir):
    return dims.seller(raw(spark, sf_dir, "sellers"))


@query
def dim_date(spark, sf_dir):
    return dims.date(raw(spark, sf_dir, "orders"))


@query
def agg_date_bounds(spark, sf_dir):
    return dims.date_bounds(raw(spark, sf_dir, "orders"))


# --- facts ------------------------------------------------------------------


@query
def fact_order(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def fact_payment(spark, sf_dir):
    return _payments(spark, sf_dir)


@query
def fact_review(spark, sf_dir):
    return _reviews(spark, sf_dir)


@query
def fact_order_increment(spark, sf_dir):
    return facts.order(ods_orders_increment(spark, sf_dir), ods_items_increment(spark, sf_dir), MONTH)


@query
def fact_payment_increment(spark, sf_dir):
    return facts.payment(ods_payments_increment(spark, sf_dir), ods_orders_increment(spark, sf_dir), MONTH)


@query
def fact_review_increment(spark, sf_dir):
    return facts.review(ods_reviews_increment(spark, sf_dir), raw(spark, sf_dir, "orders"), MONTH)


def _latest(spark, sf_dir):
    """All orders are loaded before their delivery, one month of them again after it."""
    orders, items = raw(spark, sf_dir, "orders"), raw(spark, sf_dir, "items")
    on_the_way = orders.withColumn("order_delivered_customer_date", F.lit(None).cast("timestamp_ntz"))
    before = facts.order(on_the_way, items, FULL).withColumn("dt", F.lit(EARLIER_DT))
    after = facts.order(orders, items, MONTH).withColumn("dt", F.lit(LATER_DT))
    return facts.latest(before.unionByName(after))


@query
def fact_order_latest(spark, sf_dir):
    return _latest(spark, sf_dir)


# --- summaries --------------------------------------------------------------


@query
def sum_order_by_date(spark, sf_dir):
    return summaries.order_by_date(_orders(spark, sf_dir), ALL)


@query
def sum_order_by_date_daily(spark, sf_dir):
    fact = _orders(spark, sf_dir).withColumn("dt", F.col("date_id"))
    return summaries.order_by_date(fact, Select.partition(DAY))


@query
def sum_order_by_date_daily_with_history(spark, sf_dir):
    """One day, with customers known from all of history."""
    fact = _orders(spark, sf_dir).withColumn("dt", F.col("date_id"))
    return summaries.order_by_date(fact, Select.partition(DAY), summaries.first_purchases(fact))


@query
def sum_order_by_date_latest(spark, sf_dir):
    """Orders were loaded before their delivery, one month of them again after it."""
    return summaries.order_by_date(_latest(spark, sf_dir), ALL)


@query
def sum_order_by_category_daily_with_history(spark, sf_dir):
    """One day by category, with customers known from all of history."""
    fact = _lines(spark, sf_dir).withColumn("dt", F.col("date_id"))
    known = summaries.first_purchases(fact)
    return summaries.order_by_category(fact, _products(spark, sf_dir), Select.partition(DAY), first_purchase=known)


@query
def sum_order_by_date_by_person(spark, sf_dir):
    people = dims.customer(raw(spark, sf_dir, "customers"))
    return summaries.order_by_date(_orders(spark, sf_dir), ALL, people=people)


@query
def sum_order_by_category(spark, sf_dir):
    return summaries.order_by_category(_lines(spark, sf_dir), _products(spark, sf_dir), ALL)


@query
def sum_order_by_category_as_written(spark, sf_dir):
    return summaries.order_by_category(_lines(spark, sf_dir), _products(spark, sf_dir), ALL, grain_safe=False)


@query
def sum_payment_by_date(spark, sf_dir):
    return summaries.payment_by_date(_payments(spark, sf_dir), _orders(spark, sf_dir), ALL)


@query
def sum_payment_by_date_as_written(spark, sf_dir):
    return summaries.payment_by_date(_payments(spark, sf_dir), _orders(spark, sf_dir), ALL, grain_safe=False)


@query
def sum_review_by_date(spark, sf_dir):
    return summaries.review_by_date(_reviews(spark, sf_dir), _orders(spark, sf_dir), ALL)


@query
def sum_review_by_date_as_written(spark, sf_dir):
    return summaries.review_by_date(_reviews(spark, sf_dir), _orders(spark, sf_dir), ALL, grain_safe=False)


@query
def sum_order_by_customer_region(spark, sf_dir):
    customers = dims.customer(raw(spark, sf_dir, "customers"))
    return summaries.order_by_customer_region(_orders(spark, sf_dir), customers, ALL)


@query
def sum_order_by_seller_region(spark, sf_dir):
    sellers = dims.seller(raw(spark, sf_dir, "sellers"))
    return summaries.order_by_seller_region(_lines(spark, sf_dir), sellers, ALL)


@query
def sum_order_status_by_date(spark, sf_dir):
    return summaries.order_status_by_date(raw(spark, sf_dir, "orders"), ALL)


def _board(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return boards.daily(
        dims.date(raw(spark, sf_dir, "orders")),
        summaries.order_by_date(orders, ALL),
        summaries.order_status_by_date(raw(spark, sf_dir, "orders"), ALL),
        summaries.payment_by_date(_payments(spark, sf_dir), orders, ALL),
        summaries.review_by_date(_reviews(spark, sf_dir), orders, ALL),
    )


@query
def board_daily(spark, sf_dir):
    return _board(spark, sf_dir)


def _role(table: s.Table) -> Query:
    return lambda spark, sf_dir: present(boards.cut(_board(spark, sf_dir), table))


for _table in s.BOARDS:
    QUERIES[_table.name.removesuffix("_1d")] = _role(_table)


# --- stored tables ----------------------------------------------------------


@query
def scan_snapshot_partition(spark, sf_dir):
    """Two snapshots are stored; the dimension reads one of them."""
    store, customers = scratch_store(spark), raw(spark, sf_dir, "customers")
    for dt in (EARLIER_DT, LATER_DT):
        store.overwrite(s.CUSTOMERS, customers, dt)
    return dims.customer(store.read(s.CUSTOMERS, LATER_DT))


@query
def load_overwrite_partition(spark, sf_dir):
    """Two days are stored and one is loaded again; both must hold one copy."""
    store, orders = scratch_store(spark), raw(spark, sf_dir, "orders")
    for dt in (EARLIER_DT, LATER_DT, LATER_DT):
        store.overwrite(s.ORDERS, orders, dt)
    return store.read(s.ORDERS)


@query
def load_append_partition(spark, sf_dir):
    """One day is loaded twice by appending and holds two copies."""
    store, orders = scratch_store(spark), raw(spark, sf_dir, "orders")
    for dt in (EARLIER_DT, LATER_DT, LATER_DT):
        store.append(s.ORDERS, orders, dt)
    return store.read(s.ORDERS)


# --- single rules -----------------------------------------------------------


@query
def filter_time_window(spark, sf_dir):
    orders = raw(spark, sf_dir, "orders").where(MONTH.holds(facts.PURCHASE))
    return orders.select("order_id", facts.PURCHASE)


@query
def filter_order_status(spark, sf_dir):
    return raw(spark, sf_dir, "orders").where(c.valid_status()).select("order_id", "order_status")


@query
def filter_valid_measures(spark, sf_dir):
    items = raw(spark, sf_dir, "items").where(c.valid_amount("price") & c.valid_amount("freight_value"))
    return items.select("order_id", "order_item_id", "price", "freight_value")


@query
def flag_overtime(spark, sf_dir):
    return raw(spark, sf_dir, "orders").select("order_id", c.is_overtime().alias("is_overtime"))


@query
def agg_count_distinct(spark, sf_dir):
    days = summaries.customer_level(_lines(spark, sf_dir), "date_id").groupBy("date_id")
    return days.agg(F.sum("orders").alias("order_count"), F.count("customer_id").alias("customer_count"))


@query
def agg_conditional_distinct(spark, sf_dir):
    days = summaries.customer_level(_lines(spark, sf_dir), "date_id").groupBy("date_id")
    new = F.count_if((F.col("is_new") == 1) & F.col("customer_id").isNotNull())
    return days.agg(new.alias("new_customer_count"), F.count("customer_id").alias("customer_count"))


@query
def agg_order_level(spark, sf_dir):
    level = summaries.order_level(_lines(spark, sf_dir), "date_id")
    return level.select(
        "date_id",
        "order_id",
        c.money("sum_cents").alias("order_amount"),
        F.col("items").alias("item_rows"),
        "deliver_duration",
        "total_duration",
        "is_overtime",
    )


@query
def agg_conditional_share(spark, sf_dir):
    value = c.cents("payment_value")
    split = F.sum(F.when(F.col("is_installment") == 1, value).otherwise(0))
    days = _payments(spark, sf_dir).groupBy("date_id")
    return days.agg(split.alias("split_cents"), F.sum(value).alias("all_cents")).select(
        "date_id", c.ratio("split_cents", "all_cents").alias("installment_gmv_rate")
    )


@query
def window_item_count(spark, sf_dir):
    return _fact(spark, sf_dir).select("order_id", "order_item_id", "item_count")


@query
def window_order_total(spark, sf_dir):
    return _fact(spark, sf_dir).select("order_id", "order_item_id", "total_amount", "order_total_amount")


@query
def window_payment_attempts(spark, sf_dir):
    return _payments(spark, sf_dir).select("order_id", "payment_sequential", "payment_attempts")


@query
def window_new_customer(spark, sf_dir):
    days = summaries.customer_level(_lines(spark, sf_dir), "date_id")
    return days.select("customer_id", "date_id", "is_new", F.col("items").alias("item_rows"))


@query
def fn_date_parts(spark, sf_dir):
    day = F.to_date(facts.PURCHASE)
    return raw(spark, sf_dir, "orders").select(
        "order_id",
        c.day_id(facts.PURCHASE).alias("date_id"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        c.flag(F.dayofweek(day).isin(dims.SUNDAY, dims.SATURDAY)).alias("is_weekend"),
    )


@query
def fn_durations(spark, sf_dir):
    received = "order_delivered_customer_date"
    return raw(spark, sf_dir, "orders").select(
        "order_id",
        c.days_between("order_delivered_carrier_date", received).alias("deliver_duration"),
        c.days_between(facts.PURCHASE, received).alias("total_duration"),
    )


@query
def fn_hours_to_reply(spark, sf_dir):
    answered = "review_answer_timestamp"
    return raw(spark, sf_dir, "reviews").select(
        "review_id",
        c.minutes_between(facts.CREATION, answered).alias("minutes_to_reply"),
        c.hours_to_reply(facts.CREATION, answered).alias("hours_to_reply"),
    )


@query
def fn_comment_length(spark, sf_dir):
    message = "review_comment_message"
    return raw(spark, sf_dir, "reviews").select(
        "review_id", F.char_length(message).alias("comment_count"), c.has_text(message).alias("has_comment")
    )


@query
def fn_score_bucket(spark, sf_dir):
    return raw(spark, sf_dir, "reviews").where(c.valid_score()).select(
        "review_id", "review_score", c.score_bucket().alias("score_bucket")
    )


# --- quality ----------------------------------------------------------------


@query
def quality_order_rules(spark, sf_dir):
    return quality.orders_report(raw(spark, sf_dir, "orders"), raw(spark, sf_dir, "items"))


@query
def quality_payment_rules(spark, sf_dir):
    return quality.payments_report(raw(spark, sf_dir, "payments"), raw(spark, sf_dir, "orders"))


@query
def quality_review_rules(spark, sf_dir):
    return quality.reviews_report(raw(spark, sf_dir, "reviews"), raw(spark, sf_dir, "orders"))


@query
def quality_duplicate_keys(spark, sf_dir):
    return quality.all_duplicate_keys({name: raw(spark, sf_dir, name) for name in s.RAW})


@query
def rejected_rows(spark, sf_dir):
    """Rows no fact takes, with the rules they break."""

    def rejected(name):
        _, rows = quality.split(raw(spark, sf_dir, name), name)
        return rows.select(F.lit(name).alias("table_name"), quality.key_value(s.RAW[name]), F.array_join("broken_rules", "; ").alias("broken_rules"))

    return reduce(DataFrame.unionByName, map(rejected, quality.RULES))


# --- changes between loads --------------------------------------------------


@query
def snapshot_difference(spark, sf_dir):
    """Orders, items and payments that were inserted, changed or removed."""

    def differing(name):
        found = changes.difference(state(spark, sf_dir, "before", name), state(spark, sf_dir, "now", name), s.RAW[name])
        return found.select(F.lit(name).alias("table_name"), quality.key_value(s.RAW[name]), "change", "rows_before", "rows_now")

    return reduce(DataFrame.unionByName, map(differing, ("orders", "items", "payments")))


@query
def late_rows(spark, sf_dir):
    """Payments of the source, some of them twice, that no load has taken."""
    now = state(spark, sf_dir, "now", "payments")
    twice = now.unionByName(now.where("cast(order_id as bigint) % 23 = 0"))
    return changes.surplus(twice, state(spark, sf_dir, "before", "payments"), s.PAYMENTS)


# --- snapshots as intervals -------------------------------------------------

#: Three days of payments: as before, as now, and as before again.
SNAPSHOTS = {"2001-12-30": "before", EARLIER_DT: "now", LATER_DT: "before"}


def _payment_history(spark, sf_dir):
    days = [state(spark, sf_dir, when, "payments").withColumn("dt", F.lit(dt)) for dt, when in SNAPSHOTS.items()]
    return history.intervals(reduce(DataFrame.unionByName, days), s.PAYMENTS, list(SNAPSHOTS))


@query
def snapshot_intervals(spark, sf_dir):
    return _payment_history(spark, sf_dir)


@query
def snapshot_as_of(spark, sf_dir):
    return history.as_of(_payment_history(spark, sf_dir), s.PAYMENTS, EARLIER_DT)
