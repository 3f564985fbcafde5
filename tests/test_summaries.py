"""Summaries on hand-made facts, results written out by hand."""

from decimal import Decimal

import pytest
import shop
from shop import JANUARY, by, item, order

from orderloom.functions import columns as c
from orderloom.operators import dims, facts, summaries
from orderloom.params import Select

ALL = Select.between(JANUARY)


def D(text):
    return Decimal(text)


@pytest.fixture(scope="module")
def shop_fact(spark):
    """Customer a buys twice on the 10th and once on the 12th; b buys on the 12th, nobody too."""
    orders = shop.orders(
        spark,
        order("o1", "a", bought="2020-01-10 09:00:00", carrier="2020-01-11", received="2020-01-15", promised="2020-01-14"),
        order("o2", "a", bought="2020-01-10 10:00:00", promised="2020-01-14"),
        order("o3", "a", bought="2020-01-12 09:00:00", carrier="2020-01-13", received="2020-01-14", promised="2020-01-14"),
        order("o4", "b", bought="2020-01-12 10:00:00"),
        order("o5", None, bought="2020-01-12 11:00:00"),
    )
    items = shop.items(
        spark,
        item("o1", 1, "10.00", "1.00", "chair"), item("o1", 2, "20.00", "1.00", "lamp"),
        item("o1", 3, "30.00", "1.00", "chair"),
        item("o2", 1, "5.00", "0.01", "lamp"),
        item("o3", 1, "7.00", "0.00", "odd"),
        item("o4", 1, "1.00", "0.00", "chair"),
        item("o5", 1, "2.00", "0.00", "chair"),
    )
    return facts.order(orders, items, JANUARY).cache()


def test_order_by_date(spark, shop_fact):
    found = by(summaries.order_by_date(shop_fact, ALL), "date_id")
    assert found["2020-01-10"] == {
        "date_id": "2020-01-10",
        "daily_gmv": D("68.01"),
        "daily_order_count": 2,
        "daily_customer_count": 1,
        "avg_order_amount": D("34.01"),
        "avg_customer_amount": D("68.01"),
        "avg_item_count": D("2.00"),
        "new_customer_rate": D("1.0000"),
        "avg_deliver_duration": D("4.00"),
        "avg_total_duration": D("5.00"),
        "overtime_rate": D("0.5000"),
    }
    assert found["2020-01-12"] == {
        "date_id": "2020-01-12",
        "daily_gmv": D("10.00"),
        "daily_order_count": 3,
        "daily_customer_count": 2,
        "avg_order_amount": D("3.33"),
        "avg_customer_amount": D("5.00"),
        "avg_item_count": D("1.00"),
        "new_customer_rate": D("0.5000"),
        "avg_deliver_duration": D("1.00"),
        "avg_total_duration": D("2.00"),
        "overtime_rate": D("0.0000"),
    }


def test_only_unknown_customers_leave_ratios_empty(spark):
    orders = shop.orders(spark, order("o", None))
    fact = facts.order(orders, shop.items(spark, item("o")), JANUARY)
    row = summaries.order_by_date(fact, ALL).collect()[0]
    assert (row["daily_order_count"], row["daily_customer_count"]) == (1, 0)
    assert (row["avg_customer_amount"], row["new_customer_rate"]) == (None, None)


def test_partition_mode_sees_only_its_day(spark, shop_fact):
    dated = shop_fact.withColumn("dt", shop_fact["date_id"])
    found = summaries.order_by_date(dated, Select.partition("2020-01-12")).collect()
    assert [row["date_id"] for row in found] == ["2020-01-12"]
    # With the earlier day out of sight, customer a counts as new.
    assert found[0]["new_customer_rate"] == D("1.0000")


def _products(spark):
    return dims.product(
        shop.products(spark, ("chair", "moveis"), ("lamp", "luz"), ("odd", None)),
        shop.translation(spark, ("moveis", "furniture")),
    )


def test_order_by_category(spark, shop_fact):
    found = by(summaries.order_by_category(shop_fact, _products(spark), ALL), "cate_name")
    assert set(found) == {"furniture", "luz", None}
    furniture = found["furniture"]
    # o1 holds two chairs, and its lamp counts under the lamp's category as well.
    assert (furniture["cate_gmv"], furniture["cate_order_count"], furniture["cate_customer_count"]) == (D("45.00"), 3, 2)
    assert furniture["cate_avg_item_count"] == D("1.33")
    assert furniture["cate_overtime_rate"] == D("0.3333")
    assert (found["luz"]["cate_order_count"], found["luz"]["cate_customer_count"]) == (2, 1)
    # Customer a first bought on the 10th, outside the unnamed category.
    assert found[None]["cate_new_customer_rate"] == D("0.0000")
    assert found[None]["cate_avg_deliver_duration"] == D("1.00")


def test_unnamed_category_as_written_has_no_order_level_means(spark, shop_fact):
    found = by(summaries.order_by_category(shop_fact, _products(spark), ALL, grain_safe=False), "cate_name")
    empty = ("cate_avg_deliver_duration", "cate_avg_total_duration", "cate_overtime_rate")
    assert [found[None][name] for name in empty] == [None, None, None]
    assert found[None]["cate_gmv"] == D("7.00")
    assert found["furniture"]["cate_overtime_rate"] == D("0.3333")


@pytest.fixture(scope="module")
def paid(spark):
    """Order x has three items and two payments; y has no items; z pays nothing at all."""
    orders = shop.orders(
        spark, order("x", bought="2020-01-10"), order("y", bought="2020-01-10"), order("z", bought="2020-01-11")
    )
    items = shop.items(spark, item("x", 1), item("x", 2), item("x", 3), item("z", 1))
    payments = shop.payments(
        spark,
        ("x", 1, "credit_card", 4, "30.00"), ("x", 2, "voucher", 1, "10.00"),
        ("y", 1, "voucher", 1, "99.00"), ("z", 1, "voucher", 1, "0.00"),
    )
    reviews = shop.reviews(
        spark,
        ("r1", "x", 5, "good", "2020-01-20", "2020-01-20 03:00:00"), ("r2", "z", 2, "", "2020-01-20", None),
        ("r3", "y", 1, "bad", "2020-01-20", None),
    )
    return (
        facts.order(orders, items, JANUARY),
        facts.payment(payments, orders, JANUARY),
        facts.review(reviews, orders, JANUARY),
    )


def test_payments_count_once(paid):
    fact, payments, _ = paid
    found = by(summaries.payment_by_date(payments, fact, ALL), "date_id")
    assert found["2020-01-10"] == {
        "date_id": "2020-01-10",
        "daily_payment_value": D("40.00"),
        "daily_payment_count": 2,
        "installment_rate": D("0.5000"),
        "installment_gmv_rate": D("0.7500"),
        "avg_installments": D("4.00"),
        "avg_payment_attempts": D("2.00"),
    }
    zero = found["2020-01-11"]
    assert (zero["daily_payment_value"], zero["installment_gmv_rate"], zero["avg_installments"]) == (D("0.00"), None, None)


def test_payments_as_written_count_once_per_item(paid):
    fact, payments, _ = paid
    row = by(summaries.payment_by_date(payments, fact, ALL, grain_safe=False), "date_id")["2020-01-10"]
    assert (row["daily_payment_count"], row["daily_payment_value"]) == (6, D("120.00"))
    assert (row["installment_gmv_rate"], row["avg_payment_attempts"]) == (D("0.7500"), D("2.00"))


def test_reviews(paid):
    fact, _, reviews = paid
    row = summaries.review_by_date(reviews, fact, ALL).collect()[0]
    assert row["daily_review_count"] == 2
    assert (row["avg_review_score"], row["good_review_rate"]) == (D("3.50"), D("0.5000"))
    assert (row["reply_rate"], row["avg_hours_to_reply"], row["has_comment_rate"]) == (D("0.5000"), D("3.00"), D("0.5000"))
    written = summaries.review_by_date(reviews, fact, ALL, grain_safe=False).collect()[0]
    assert (written["daily_review_count"], written["avg_review_score"]) == (4, D("4.25"))


def test_daily_mode_takes_payments_of_the_day(paid):
    fact, payments, reviews = paid
    fact, payments = [rows.withColumn("dt", rows["date_id"]) for rows in (fact, payments)]
    found = by(summaries.payment_by_date(payments, fact, Select.partition("2020-01-10")), "date_id")
    assert set(found) == {"2020-01-10"} and found["2020-01-10"]["daily_payment_count"] == 2
    # Reviews come days after the purchase and still find their order.
    reviews = reviews.withColumn("dt", reviews["date_id"])
    assert summaries.review_by_date(reviews, fact, Select.partition("2020-01-20")).collect()[0]["daily_review_count"] == 2


def test_status_by_date(spark):
    states = ("canceled", "unavailable", None, "delivered")
    orders = shop.orders(spark, *[order(str(n), status=state) for n, state in enumerate(states)])
    row = summaries.order_status_by_date(orders, ALL).collect()[0]
    assert (row["placed_order_count"], row["canceled_order_count"], row["unknown_order_count"]) == (4, 1, 1)
    assert (row["canceled_rate"], row["unavailable_rate"]) == (D("0.2500"), D("0.2500"))


def test_sums_do_not_overflow_ten_digits(spark):
    orders = shop.orders(spark, order("o"))
    items = shop.items(spark, *[item("o", n, "99999999.99", "0.00") for n in range(1, 13)])
    fact = facts.order(orders, items, JANUARY)
    row = summaries.order_by_date(fact, ALL).collect()[0]
    assert row["daily_gmv"] == D("1199999999.88")
    assert fact.collect()[0]["order_total_amount"] == D("1199999999.88")


def test_history_makes_a_day_know_earlier_customers(shop_fact):
    dated = shop_fact.withColumn("dt", shop_fact["date_id"])
    history = summaries.first_purchases(dated)
    row = summaries.order_by_date(dated, Select.partition("2020-01-12"), history).collect()[0]
    assert row["new_customer_rate"] == D("0.5000")


def test_people_behind_several_customer_ids_count_once(spark, shop_fact):
    people = spark.createDataFrame([("a", "same"), ("b", "same")], "customer_id string, customer_unique_id string")
    found = by(summaries.order_by_date(shop_fact, ALL, people=people), "date_id")
    assert found["2020-01-12"]["daily_customer_count"] == 1
    assert found["2020-01-12"]["new_customer_rate"] == D("0.0000")


def test_rounding_is_exact_for_any_size(spark):
    rows = spark.createDataFrame(
        [(1, 8), (-1, 8), (1, 3), (5, 0), (9 * 10**18, 9 * 10**18 - 1), (3, 10**18), (None, 2)],
        "part bigint, total bigint",
    )
    found = rows.select(c.ratio("part", "total", c.MEAN), c.ratio("part", "total"), c.mean_money("part", "total")).collect()
    assert [tuple(row) for row in found] == [
        (D("0.13"), D("0.1250"), D("0.00")),
        (D("-0.13"), D("-0.1250"), D("0.00")),
        (D("0.33"), D("0.3333"), D("0.00")),
        (None, None, None),
        (D("1.00"), D("1.0000"), D("0.01")),
        (D("0.00"), D("0.0000"), D("0.00")),
        (None, None, None),
    ]


def test_repeats_of_a_busy_order_do_not_overflow(spark):
    """Three million items times three million payments of one order, given as stored facts."""
    many = 3_000_000
    fact = spark.range(many).selectExpr("'o' as order_id", "timestamp_ntz '2020-01-10' as order_purchase_timestamp")
    payments = spark.range(many).selectExpr(
        "'o' as order_id", "'2020-01-10' as date_id", "cast(90000000.01 as decimal(10,2)) as payment_value",
        "1 as is_installment", "2 as payment_installments", "7 as payment_attempts",
    )
    row = summaries.payment_by_date(payments, fact, ALL, grain_safe=False).collect()[0]
    assert row["daily_payment_count"] == many**2
    assert row["daily_payment_value"] == many**2 * D("90000000.01")
    assert (row["installment_gmv_rate"], row["avg_installments"]) == (D("1.0000"), D("2.00"))
