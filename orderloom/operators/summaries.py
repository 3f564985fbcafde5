"""Summaries of the facts by day, category and region.

Facts hold item rows, so nothing joins them for existence and no order-level
value is averaged over items. Rows are first combined to order grain, then to
the grain of the summary. Item rows move once as they are; every later step
combines before it shuffles, so a hot order, customer, product or day is one
small row per task by the time it meets the rest of its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import columns as c
from orderloom.operators.facts import PURCHASE
from orderloom.operators.order_groups import deal
from orderloom.params import Select
from orderloom.schemas import (
    SUM_ORDER_BY_CATEGORY,
    SUM_ORDER_BY_CUSTOMER_REGION,
    SUM_ORDER_BY_DATE,
    SUM_ORDER_BY_SELLER_REGION,
    SUM_PAYMENT_BY_DATE,
    SUM_REVIEW_BY_DATE,
    SUM_STATUS_BY_DATE,
)

_TASK = "__task"
_ADDED = ("items", "orders", "deliver_days", "delivered", "total_days", "completed", "late")


def _count() -> Column:
    return F.count(F.lit(1))


def _items(rows: DataFrame) -> Column:
    return F.sum("items") if "items" in rows.columns else _count()


def _order_values(rows: DataFrame) -> list[Column]:
    """What orders combine of item rows, or of ``facts.order_sums``, which are orders already."""
    return [
        (F.col("sum_cents") if "sum_cents" in rows.columns else c.cents("total_amount")).alias("sum_cents"),
        (F.col("items") if "items" in rows.columns else F.lit(1).cast("long")).alias("items"),
        F.col("deliver_duration"),
        F.col("total_duration"),
        c.is_overtime().alias("is_overtime"),
        # A date, not the text of date_id: a text minimum would turn the hash aggregate into a sort.
        F.to_date(PURCHASE).alias("bought_on"),
    ]


def order_level(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per order within ``keys``: amount, items, durations, lateness.

    Item rows are dealt anew, so that the task that joined them need not hold their groups as well. They are
    combined apart for every task they come from, which leaves few rows of a hot order for the task that ends it.
    """
    by = [*keys, "order_id"]
    combined = [F.sum("sum_cents").alias("sum_cents"), F.sum("items").alias("items")]
    combined += [F.max(name).alias(name) for name in ("deliver_duration", "total_duration", "is_overtime")]
    combined.append(F.min("bought_on").alias("bought_on"))
    values = rows.select(*by, *_order_values(rows))
    if "items" not in rows.columns:
        apart = deal(values.withColumn(_TASK, F.spark_partition_id()), *by, _TASK)
        values = deal(apart.groupBy(*by, _TASK).agg(*combined).drop(_TASK), *by)
    return values.groupBy(*by).agg(*combined)


def _merged(dimension: DataFrame) -> DataFrame:
    """A dimension of the lines, joined by shuffle whatever its files weigh.

    Spark weighs it by its packed files. Broadcast, a few MB of them are unpacked into every task that joins lines,
    and grow there with the dimension.
    """
    return dimension.hint("merge")


def by_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Count people: the customer id of each order becomes the id of the person behind it.

    Orders without customer match nobody; kept out of the join they form no hot group.
    """
    people = customers.select("customer_id", "customer_unique_id")
    person = F.coalesce("customer_unique_id", "customer_id")
    named = orders.where(F.col("customer_id").isNotNull()).join(people, "customer_id", "left")
    named = named.withColumn("customer_id", person).drop("customer_unique_id")
    return named.unionByName(orders.where(F.col("customer_id").isNull()))


def first_purchases(fact: DataFrame) -> DataFrame:
    """First day of every customer, as history for a summary that reads later rows only."""
    known = fact.where(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(F.min(F.to_date(PURCHASE)).alias("first_day"))


def customer_level(
    rows: DataFrame, *keys: str, first_purchase: DataFrame | None = None, people: DataFrame | None = None
) -> DataFrame:
    """One row per customer within ``keys``; ``is_new`` when the customer's first day falls in them.

    The first day is taken over all rows given, and over ``first_purchase``
    where that is given. It is found on the combined rows: a customer has one
    of them per key, so the window holds groups that do not grow with the
    number of orders. With ``people`` the customers are people.
    """
    by = [*keys, "customer_id"]
    orders = order_level(rows, *by)
    if people is not None:
        orders = by_person(orders, people)
    customers = orders.groupBy(*by).agg(
        F.sum("sum_cents").alias("sum_cents"),
        F.sum("items").alias("items"),
        _count().alias("orders"),
        F.sum("deliver_duration").alias("deliver_days"),
        F.count("deliver_duration").alias("delivered"),
        F.sum("total_duration").alias("total_days"),
        F.count("total_duration").alias("completed"),
        F.sum("is_overtime").alias("late"),
        F.min("bought_on").alias("bought_on"),
    )
    first_day = F.min("bought_on").over(Window.partitionBy("customer_id"))
    if first_purchase is not None:
        # Narrowed to the customers at hand, so that history is filtered before it is shuffled.
        known = first_purchase.join(customers.select("customer_id"), "customer_id", "left_semi")
        customers = customers.join(known, "customer_id", "left")
        first_day = F.least(first_day, F.col("first_day"))
    return customers.withColumn("is_new", c.flag(F.col("bought_on") == first_day)).drop("first_day")


def _order_metrics(customers: DataFrame, keys: list[str], prefix: str, total: str) -> DataFrame:
    """The ten metrics from rows of ``customer_level``."""
    known = F.col("customer_id").isNotNull()
    grouped = customers.groupBy(*keys).agg(
        F.sum(c.whole("sum_cents")).alias("sum_cents"),
        *[F.sum(name).alias(name) for name in _ADDED],
        F.count("customer_id").alias("customers"),
        F.sum(F.when(known, F.col("is_new")).otherwise(0)).alias("new_customers"),
    )
    return grouped.select(
        *keys,
        c.money("sum_cents").alias(f"{total}_gmv"),
        F.col("orders").alias(f"{total}_order_count"),
        F.col("customers").alias(f"{total}_customer_count"),
        c.mean_money("sum_cents", "orders").alias(f"{prefix}avg_order_amount"),
        c.mean_money("sum_cents", "customers").alias(f"{prefix}avg_customer_amount"),
        c.ratio("items", "orders", c.MEAN).alias(f"{prefix}avg_item_count"),
        c.ratio("new_customers", "customers").alias(f"{prefix}new_customer_rate"),
        c.ratio("deliver_days", "delivered", c.MEAN).alias(f"{prefix}avg_deliver_duration"),
        c.ratio("total_days", "completed", c.MEAN).alias(f"{prefix}avg_total_duration"),
        c.ratio("late", "orders").alias(f"{prefix}overtime_rate"),
    )


def order_by_date(
    fact: DataFrame, select: Select, first_purchase: DataFrame | None = None, people: DataFrame | None = None
) -> DataFrame:
    """``people``: the customer dimension, to count people instead of customer ids."""
    rows = select(fact, PURCHASE)
    customers = customer_level(rows, "date_id", first_purchase=first_purchase, people=people)
    return SUM_ORDER_BY_DATE.conform(_order_metrics(customers, ["date_id"], "", "daily"))


def order_by_category(
    fact: DataFrame,
    products: DataFrame,
    select: Select,
    grain_safe: bool = True,
    first_purchase: DataFrame | None = None,
) -> DataFrame:
    """``grain_safe=False`` leaves durations and lateness of the unnamed category empty."""
    names = products.select("product_id", F.col("product_category_en").alias("cate_name"))
    rows = select(fact, PURCHASE).join(_merged(names), "product_id")
    metrics = _order_metrics(customer_level(rows, "cate_name", first_purchase=first_purchase), ["cate_name"], "cate_", "cate")
    if not grain_safe:
        for name in ("cate_avg_deliver_duration", "cate_avg_total_duration", "cate_overtime_rate"):
            metrics = metrics.withColumn(name, F.when(F.col("cate_name").isNotNull(), F.col(name)))
    return SUM_ORDER_BY_CATEGORY.conform(metrics)


def order_by_customer_region(fact: DataFrame, customers: DataFrame, select: Select) -> DataFrame:
    """Customers are located after their orders are combined, so a busy customer joins as one row.

    Orders of unknown customers count in the region without a name. There is no share of new customers: a
    customer has one region, so all would be new.
    """
    keys = ["customer_state", "customer_city"]
    located = customer_level(select(fact, PURCHASE)).join(customers.select("customer_id", *keys), "customer_id", "left")
    return SUM_ORDER_BY_CUSTOMER_REGION.conform(_order_metrics(located, keys, "region_", "region"))


def order_by_seller_region(
    fact: DataFrame, sellers: DataFrame, select: Select, first_purchase: DataFrame | None = None
) -> DataFrame:
    """Items of unknown sellers count in the region without a name."""
    keys = ["seller_state", "seller_city"]
    rows = select(fact, PURCHASE).join(_merged(sellers.select("seller_id", *keys)), "seller_id", "left")
    return SUM_ORDER_BY_SELLER_REGION.conform(_order_metrics(customer_level(rows, *keys, first_purchase=first_purchase), keys, "region_", "region"))


def order_status_by_date(orders: DataFrame, select: Select) -> DataFrame:
    """Orders of every state, the ones the order fact leaves out included."""
    status = F.col("order_status")
    counted = (
        select(orders, PURCHASE)
        .groupBy(c.day_id(PURCHASE).alias("date_id"))
        .agg(
            _count().alias("placed_order_count"),
            F.count_if(status == "canceled").alias("canceled_order_count"),
            F.count_if(status == "unavailable").alias("unavailable_order_count"),
            F.count_if(status.isNull()).alias("unknown_order_count"),
        )
    )
    return SUM_STATUS_BY_DATE.conform(
        counted.withColumn("canceled_rate", c.ratio("canceled_order_count", "placed_order_count")).withColumn(
            "unavailable_rate", c.ratio("unavailable_order_count", "placed_order_count")
        )
    )


def _with_order_lines(per_order: DataFrame, fact: DataFrame, select: Select, grain_safe: bool) -> DataFrame:
    """Keep the orders that have fact rows; ``weight`` is how often each of their rows counts.

    Joining item rows would repeat every row once per item. The repeats are a
    factor per order, so they are multiplied in rather than produced.
    """
    fact = select.by_time(fact, PURCHASE)
    fact = fact.select("order_id", *[name for name in ("items",) if name in fact.columns])
    if select.dt:
        # One day against all history: drop the other orders where they are
        # read, before their ids are shuffled.
        fact = fact.join(per_order.select("order_id"), "order_id", "left_semi")
    lines = fact.groupBy("order_id").agg(_items(fact).alias("weight"))
    if grain_safe:
        return per_order.join(lines.select("order_id"), "order_id", "left_semi")
    return per_order.join(lines, "order_id")


def _weighted(grain_safe: bool, *names: str) -> list[Column]:
    """Totals of the columns; weights multiply past 64 bits for an order with many rows on both sides."""
    if grain_safe:
        return [F.sum(name).alias(name) for name in names]
    return [F.sum(c.whole(name) * c.whole("weight")).alias(name) for name in names]


def payment_by_date(payments: DataFrame, fact: DataFrame, select: Select, grain_safe: bool = True) -> DataFrame:
    """Payments of orders in the order fact; ``grain_safe=False`` counts each once per item."""
    paid = F.col("is_installment") == 1
    per_order = (
        select.by_partition(payments)
        .groupBy("date_id", "order_id")
        .agg(
            _count().alias("payments"),
            F.sum(c.cents("payment_value")).alias("sum_cents"),
            F.sum("is_installment").alias("split_payments"),
            F.sum(F.when(paid, c.cents("payment_value")).otherwise(0)).alias("split_cents"),
            F.sum(F.when(paid, F.col("payment_installments")).otherwise(0)).alias("split_parts"),
            F.max("payment_attempts").alias("attempts"),
        )
    )
    rows = _with_order_lines(per_order, fact, select, grain_safe)
    grouped = rows.groupBy("date_id").agg(
        *_weighted(grain_safe, "payments", "sum_cents", "split_payments", "split_cents", "split_parts"),
        F.sum("attempts").alias("attempts"),
        _count().alias("orders"),
    )
    return SUM_PAYMENT_BY_DATE.conform(
        grouped.select(
            "date_id",
            c.money("sum_cents").alias("daily_payment_value"),
            F.col("payments").alias("daily_payment_count"),
            c.ratio("split_payments", "payments").alias("installment_rate"),
            c.ratio("split_cents", "sum_cents").alias("installment_gmv_rate"),
            c.ratio("split_parts", "split_payments", c.MEAN).alias("avg_installments"),
            c.ratio("attempts", "orders", c.MEAN).alias("avg_payment_attempts"),
        )
    )


def review_by_date(reviews: DataFrame, fact: DataFrame, select: Select, grain_safe: bool = True) -> DataFrame:
    """Reviews of orders in the order fact; ``grain_safe=False`` counts each once per item."""
    per_order = (
        select.by_partition(reviews)
        .groupBy("date_id", "order_id")
        .agg(
            _count().alias("reviews"),
            F.sum("review_score").alias("score"),
            F.sum("is_good_review").alias("good"),
            F.sum("is_reply").alias("replied"),
            F.sum("hours_to_reply").alias("hours"),
            F.count("hours_to_reply").alias("timed"),
            F.sum("has_comment").alias("commented"),
        )
    )
    rows = _with_order_lines(per_order, fact, select, grain_safe)
    grouped = rows.groupBy("date_id").agg(
        *_weighted(grain_safe, "reviews", "score", "good", "replied", "hours", "timed", "commented")
    )
    return SUM_REVIEW_BY_DATE.conform(
        grouped.select(
            "date_id",
            F.col("reviews").alias("daily_review_count"),
            c.ratio("score", "reviews", c.MEAN).alias("avg_review_score"),
            c.ratio("good", "reviews").alias("good_review_rate"),
            c.ratio("replied", "reviews").alias("reply_rate"),
            c.ratio("hours", "timed", c.MEAN).alias("avg_hours_to_reply"),
            c.ratio("commented", "reviews").alias("has_comment_rate"),
        )
    )
