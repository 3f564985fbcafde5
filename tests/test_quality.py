"""Rule counts, unknown orders and repeated keys."""

import shop
from shop import by, item, order

from orderloom import schemas as s
from orderloom.operators import facts, quality


def test_rules_count_each_fault(spark):
    orders = shop.orders(spark, order("a"), order("b", status=None), order("c", "x", "canceled"), order(None, None, bought=None))
    items = shop.items(
        spark, item("a", price=None), item("a", price="-1.00"), item("gone", freight="-1.00"), item("gone"), item(None)
    )
    found = by(quality.orders_report(orders, items), "table_name", "rule")
    failed = {key: row["failed_rows"] for key, row in found.items()}
    assert failed["orders", "status missing"] == 1
    assert failed["orders", "status void"] == 1
    assert failed["orders", "order_id missing"] == failed["orders", "customer_id missing"] == 1
    assert failed["orders", "purchase time missing"] == 1
    assert failed["items", "price missing"] == failed["items", "price negative"] == failed["items", "freight negative"] == 1
    assert failed["items", "order unknown"] == 2
    assert found["items", "price missing"]["checked_rows"] == 5


def test_payment_and_review_rules(spark):
    orders = shop.orders(spark, order("a"))
    payments = shop.payments(spark, ("a", 0, "x", 0, "1.00"), ("a", 1, "x", None, None), ("z", None, "x", 1, "-1.00"))
    failed = {r["rule"]: r["failed_rows"] for r in quality.payments_report(payments, orders).collect()}
    assert failed == {
        "order_id missing": 0, "payment_sequential missing": 1, "payment_sequential below 1": 1,
        "instalments missing": 1, "instalments zero": 1, "value missing": 1, "value negative": 1, "order unknown": 1,
    }
    reviews = shop.reviews(spark, ("r", "a", 0, None, "2020-01-01", None), (None, None, None, None, None, None))
    failed = {r["rule"]: r["failed_rows"] for r in quality.reviews_report(reviews, orders).collect()}
    assert failed == {
        "order_id missing": 1, "review_id missing": 1, "score missing": 1, "score out of range": 1,
        "creation time missing": 1, "order unknown": 0,
    }


def test_empty_tables_report_zero(spark):
    none = shop.orders(spark, order("a")).where("false")
    rows = quality.orders_report(none, shop.items(spark, item("a")).where("false")).collect()
    assert {(r["checked_rows"], r["failed_rows"]) for r in rows} == {(0, 0)}


def test_duplicate_keys(spark):
    items = shop.items(spark, item("a", 1), item("a", 1), item("a", 2), item("b", None), item("b", None))
    found = by(quality.duplicate_keys(items, s.ITEMS, "items"), "key_value")
    assert {key: row["n_rows"] for key, row in found.items()} == {"a|1": 2, r"b|\N": 2}


def test_clean_and_rejected_rows_are_all_rows(spark):
    orders = shop.orders(spark, order("a"), order("b", status=None), order("c", "x", "canceled"), order(None, None, bought=None))
    items = shop.items(spark, item("a"), item("a"), item("a", price=None, freight="-1.00"), item("b"), item("c", price="-1.00"), item(None))
    payments = shop.payments(spark, ("a", 0, "x", 0, "1.00"), ("a", 1, "x", 0, "1.00"), ("a", None, "x", None, None), ("b", 1, "x", 1, "-1.00"))
    reviews = shop.reviews(spark, ("r", "a", 5, "t", "2020-01-05", None), ("r", "a", 6, "t", "2020-01-05", None), (None, "a", None, "t", None, None))
    given = {"orders": orders, "items": items, "payments": payments, "reviews": reviews}
    broken = {}
    for name, rows in given.items():
        clean, rejected = quality.split(rows, name)
        assert sorted(map(repr, clean.unionByName(rejected.drop("broken_rules")).collect())) == sorted(map(repr, rows.collect()))
        broken[name] = sorted(tuple(r.broken_rules) for r in rejected.collect())
    assert broken["orders"] == [("order_id missing", "customer_id missing", "purchase time missing"), ("status missing",), ("status void",)]
    assert broken["items"] == [("order_id missing",), ("price missing", "freight negative"), ("price negative",)]
    # A payment in no instalments is mended, not rejected.
    assert broken["payments"] == [("payment_sequential below 1",), ("payment_sequential missing", "instalments missing", "value missing"), ("value negative",)]
    assert broken["reviews"] == [("review_id missing", "score missing", "creation time missing"), ("score out of range",)]


def test_what_is_clean_is_what_the_facts_load(spark):
    """Of orders that are clean themselves and bought in the window."""
    orders = shop.orders(spark, order("a"), order("b", status="canceled"))
    items = shop.items(spark, item("a"), item("a", 2, price=None), item("b"))
    payments = shop.payments(spark, ("a", 1, "x", 0, "1.00"), ("a", 0, "x", 1, "1.00"))
    clean = {name: quality.split(rows, name)[0] for name, rows in (("orders", orders), ("items", items), ("payments", payments))}
    assert facts.order(orders, items, shop.JANUARY).count() == clean["items"].join(clean["orders"], "order_id", "left_semi").count() == 1
    assert facts.payment(payments, orders, shop.JANUARY).count() == clean["payments"].join(orders, "order_id", "left_semi").count() == 1
