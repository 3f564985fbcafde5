"""Small hand-made shop rows; every helper fills the columns a test does not care about."""

from datetime import datetime
from decimal import Decimal

from orderloom import schemas as s
from orderloom.params import LoadWindow

JANUARY = LoadWindow("2020-01-01", "2020-02-01", "2020-02-01")


def at(text):
    return datetime.fromisoformat(text) if text else None


def dec(text):
    return Decimal(text) if text is not None else None


def orders(spark, *rows):
    """(order_id, customer_id, status, purchase, carrier, customer, estimate)"""
    data = [(o, c, st, at(p), at(p), at(ca), at(cu), at(e)) for o, c, st, p, ca, cu, e in rows]
    return spark.createDataFrame(data, s.ORDERS.schema)


def order(order_id, customer="c1", status="delivered", bought="2020-01-10 12:00:00", carrier=None, received=None,
          promised=None):
    return order_id, customer, status, bought, carrier, received, promised


def items(spark, *rows):
    """(order_id, item, product, seller, price, freight)"""
    data = [(o, i, p, se, at("2020-01-12"), dec(pr), dec(fr)) for o, i, p, se, pr, fr in rows]
    return spark.createDataFrame(data, s.ITEMS.schema)


def item(order_id, number=1, price="10.00", freight="1.00", product="p1", seller="s1"):
    return order_id, number, product, seller, price, freight


def payments(spark, *rows):
    """(order_id, sequential, type, installments, value)"""
    return spark.createDataFrame([(o, n, t, i, dec(v)) for o, n, t, i, v in rows], s.PAYMENTS.schema)


def reviews(spark, *rows):
    """(review_id, order_id, score, message, created, answered)"""
    data = [(r, o, sc, "title", m, at(c), at(a)) for r, o, sc, m, c, a in rows]
    return spark.createDataFrame(data, s.REVIEWS.schema)


def products(spark, *rows):
    """(product_id, category)"""
    return spark.createDataFrame([(p, c, 1, 2, 3, 4, 5, 6, 7) for p, c in rows], s.PRODUCTS.schema)


def translation(spark, *rows):
    return spark.createDataFrame(list(rows), s.TRANSLATION.schema)


def by(frame, *keys):
    """Collected rows as dicts, by key."""
    return {tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]: row.asDict() for row in frame.collect()}
