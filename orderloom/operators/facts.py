"""Cleaned facts: order items, payments and reviews, each joined to its order.

The same builders serve the full load and the daily increment; only the inputs
and the window differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import columns as c
from orderloom.operators.order_groups import join_orders
from orderloom.params import LoadWindow
from orderloom.schemas import FACT_ORDER, FACT_PAYMENT, FACT_REVIEW

PURCHASE = "order_purchase_timestamp"
CREATION = "review_creation_date"
MILESTONES = ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")


def _present(*names: str) -> Column:
    condition = F.col(names[0]).isNotNull()
    for name in names[1:]:
        condition = condition & F.col(name).isNotNull()
    return condition


def _bought(orders: DataFrame, window: LoadWindow | None) -> DataFrame:
    return orders.where(window.holds(PURCHASE)) if window else orders


def item_is_valid() -> Column:
    return (
        _present("order_id", "order_item_id", "product_id", "seller_id")
        & c.valid_amount("price")
        & c.valid_amount("freight_value")
    )


def valid_items(items: DataFrame) -> DataFrame:
    return items.where(item_is_valid())


def order_totals() -> dict[str, Column]:
    return {
        "item_count": F.count("order_item_id"),
        "order_total_amount": F.sum("total_amount"),
    }


def _sound_orders(orders: DataFrame, window: LoadWindow | None) -> DataFrame:
    return _bought(orders.where(c.valid_status()), window).select(
        "order_id",
        "customer_id",
        "order_status",
        PURCHASE,
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        c.day_id(PURCHASE).alias("date_id"),
        c.days_between("order_delivered_carrier_date", "order_delivered_customer_date").alias("deliver_duration"),
        c.days_between(PURCHASE, "order_delivered_customer_date").alias("total_duration"),
    )


def _order_lines(
    orders: DataFrame, items: DataFrame, window: LoadWindow | None, totals: dict[str, Column] | None
) -> DataFrame:
    kept = _sound_orders(orders, window)
    lines = valid_items(items).select(
        "order_id",
        "order_item_id",
        "seller_id",
        "product_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_amount"),
    )
    return join_orders(lines, kept, totals)


def order(orders: DataFrame, items: DataFrame, window: LoadWindow | None) -> DataFrame:
    """Valid items of the fulfilled orders bought in the window; without one, of all orders given."""
    return FACT_ORDER.conform(_order_lines(orders, items, window, order_totals()))


def order_lines(orders: DataFrame, items: DataFrame, window: LoadWindow) -> DataFrame:
    """The order fact without its order totals, for summaries fed straight from raw rows."""
    return _order_lines(orders, items, window, None)


def order_sums(orders: DataFrame, items: DataFrame, window: LoadWindow) -> DataFrame:
    """The fulfilled orders, one row each, with what their valid items come to.

    For summaries that need no single item. Items are added up before they move and meet the orders one to one.
    """
    amount = c.cents(F.col("price") + F.col("freight_value"))
    sums = valid_items(items).groupBy("order_id").agg(F.sum(amount).alias("sum_cents"), F.count(F.lit(1)).alias("items"))
    return _sound_orders(orders, window).join(sums, "order_id")


def latest(fact: DataFrame) -> DataFrame:
    """Of every order the rows of its newest ``dt``, where later loads brought later states of it."""
    loaded = fact.withColumn("loaded_on", F.to_date("dt"))
    newest = loaded.groupBy("order_id").agg(F.max("loaded_on").alias("newest"))
    joined = join_orders(loaded, newest)
    return joined.where(F.col("loaded_on") == F.col("newest")).drop("loaded_on", "newest")


def valid_payments(payments: DataFrame) -> DataFrame:
    return payments.where(
        _present("order_id", "payment_sequential", "payment_installments")
        & c.valid_amount("payment_value")
        & (F.col("payment_sequential") >= 1)
    )


def payment(payments: DataFrame, orders: DataFrame, window: LoadWindow | None) -> DataFrame:
    """Valid payments of the orders bought in the window, void orders included; without one, of all orders given."""
    kept = _bought(orders.where(_present("customer_id")), window).select(
        "order_id", "customer_id", c.day_id(PURCHASE).alias("date_id")
    )
    lines = valid_payments(payments).select(
        "order_id",
        "payment_sequential",
        "payment_type",
        c.repaired_installments().alias("payment_installments"),
        "payment_value",
        c.flag(F.col("payment_installments") > 1).alias("is_installment"),
    )
    totals = {"payment_attempts": F.max("payment_sequential")}
    return FACT_PAYMENT.conform(join_orders(lines, kept, totals))


def valid_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.where(_present("order_id", "review_id") & c.valid_score())


def review(reviews: DataFrame, orders: DataFrame, window: LoadWindow) -> DataFrame:
    """Valid reviews created in the window, whenever their order was bought."""
    kept = orders.where(_present("customer_id")).select("order_id", "customer_id", "order_delivered_customer_date")
    lines = valid_reviews(reviews).where(window.holds(CREATION)).select(
        "order_id",
        "review_id",
        c.day_id(CREATION).alias("date_id"),
        "review_comment_message",
        CREATION,
        "review_answer_timestamp",
        "review_score",
        c.score_bucket().alias("score_bucket"),
        c.flag(F.col("review_score") >= c.GOOD_SCORE_MIN).alias("is_good_review"),
        c.flag(F.col("review_answer_timestamp").isNotNull()).alias("is_reply"),
        c.hours_to_reply(CREATION, "review_answer_timestamp").alias("hours_to_reply"),
        F.char_length("review_comment_message").alias("comment_count"),
        c.has_text("review_comment_message").alias("has_comment"),
    )
    joined = join_orders(lines, kept)
    return FACT_REVIEW.conform(
        joined.withColumn("days_to_review", c.days_between("order_delivered_customer_date", CREATION))
    )
