"""Dimensions: translation fallback and the calendar."""

import shop
from shop import by, order

from orderloom.operators import dims


def test_product_category_falls_back_to_the_source_name(spark):
    products = shop.products(spark, ("a", "moveis"), ("b", "sem_nome"), ("c", None))
    translation = shop.translation(spark, ("moveis", "furniture"), (None, "nothing"))
    found = by(dims.product(products, translation), "product_id")
    assert {p: (r["product_category_pt"], r["product_category_en"]) for p, r in found.items()} == {
        "a": ("moveis", "furniture"),
        "b": ("sem_nome", "sem_nome"),
        "c": (None, None),
    }
    assert found["a"]["product_weight_g"] == 4


def test_calendar_runs_past_the_last_purchase(spark):
    orders = shop.orders(
        spark, order("a", bought="2020-02-28 23:00:00"), order("b", bought="2020-03-01"), order("c", bought=None)
    )
    found = by(dims.date(orders, horizon_days=7), "date_id")
    assert sorted(found) == [
        "2020-02-28", "2020-02-29", "2020-03-01", "2020-03-02", "2020-03-03", "2020-03-04", "2020-03-05",
        "2020-03-06", "2020-03-07", "2020-03-08",
    ]
    assert found["2020-02-29"] == {
        "date_id": "2020-02-29", "year": 2020, "quarter": 1, "month": 2, "day": 29, "is_weekend": 1,
    }
    assert [day for day, row in found.items() if row["is_weekend"]] == [
        "2020-02-29", "2020-03-01", "2020-03-07", "2020-03-08",
    ]


def test_calendar_keeps_every_day_of_a_long_history(spark):
    far = shop.orders(spark, order("a", bought="1950-01-01"), order("b", bought="2011-06-30"))
    days = dims.date(far)
    assert days.count() == 22461 + dims.HORIZON_DAYS
    assert days.where("date_id between '1950-01-01' and '2011-06-30'").count() == 22461
    near = shop.orders(spark, order("a", bought="2000-01-01"), order("b", bought="2000-01-03"))
    assert dims.date(near).count() == dims.HORIZON_DAYS + 3
