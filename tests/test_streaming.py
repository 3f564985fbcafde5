"""A stream of orders lands once in the day of each purchase and feeds the daily load."""

import shop
from shop import item, order

from orderloom import schemas as s
from orderloom.operators import ods
from orderloom.operators.facts import PURCHASE
from orderloom.params import LoadWindow
from orderloom.plans import loads
from orderloom.sources.tables import Store
from orderloom.streaming.facts import load_day, standing, take
from orderloom.streaming.increment import land, landed


def test_orders_land_by_day_and_only_once(spark, tmp_path):
    inbox, store = str(tmp_path / "inbox"), Store(spark, str(tmp_path / "store"))

    def run():
        stream = spark.readStream.schema(s.ORDERS.schema).parquet(inbox)
        land(stream, s.ORDERS, PURCHASE, store, str(tmp_path / "checkpoint")).awaitTermination()
        return {row["dt"]: row["count"] for row in landed(store, s.ORDERS).groupBy("dt").count().collect()}

    shop.orders(spark, order("a", bought="2020-01-01 23:59:59"), order("b", bought="2020-01-02"),
                order("never", bought=None)).write.parquet(inbox)
    assert run() == {"2020-01-01": 1, "2020-01-02": 1, "unknown": 1}
    assert run() == {"2020-01-01": 1, "2020-01-02": 1, "unknown": 1}
    shop.orders(spark, order("late", bought="2020-01-01 10:00:00")).write.mode("append").parquet(inbox)
    assert run() == {"2020-01-01": 2, "2020-01-02": 1, "unknown": 1}
    assert landed(store, s.ORDERS, "2020-01-02").collect()[0]["order_id"] == "b"

    day = LoadWindow("2020-01-01", "2020-01-02", "2020-01-02")
    taken = ods.append_window(landed(store, s.ORDERS), s.ORDERS, PURCHASE, day).collect()
    assert sorted((row["order_id"], row["dt"]) for row in taken) == [("a", "2020-01-02"), ("late", "2020-01-02")]


def test_streams_end_where_a_batch_load_does(spark, tmp_path):
    """Also where a batch is run again, as after a failure, and where later rows take the place of earlier ones."""
    store, inbox = Store(spark, str(tmp_path / "store"), buckets=4), str(tmp_path / "inbox")
    others = {name: spark.createDataFrame([], s.RAW[name].schema) for name in ("customers", "sellers", "products", "translation", "geolocation")}
    make = {"orders": shop.orders, "items": shop.items, "payments": shop.payments, "reviews": shop.reviews}
    bought = {"bought": "2020-01-02 10:00:00"}
    first = {
        "orders": [order("a", **bought), order("b", **bought)],
        "items": [item("a"), item("b"), item("b", 2)],
        "payments": [("a", 1, "card", 1, "11.00"), ("b", None, "card", 1, "5.00")],
        "reviews": [("r", "a", 5, "t", "2020-01-02 12:00:00", None)],
    }
    second = {
        "orders": [order("b", status="canceled", **bought), order("c", **bought)],
        "items": [item("a", price="20.00"), item("c")],
        "payments": [("a", 2, "card", 1, "1.00")],
        "reviews": [("r", "a", 1, "t", "2020-01-02 12:00:00", None), ("q", "c", 4, None, "2020-01-03 01:00:00", None)],
    }
    for n, rows in ((2, first), (3, second)):
        for name, some in rows.items():
            make[name](spark, *some).write.mode("append").parquet(f"{inbox}/{name}")
        streams = {name: spark.readStream.schema(s.RAW[name].schema).parquet(f"{inbox}/{name}") for name in make}
        load_day(streams, others, store, str(tmp_path / "checkpoint"), LoadWindow(f"2020-01-0{n}", f"2020-01-0{n + 1}", f"2020-01-0{n}"))
    for name, some in second.items():
        take(store, s.RAW[name], make[name](spark, *some), 1)
    last = {
        "orders": [order("a", **bought), *second["orders"]],
        "items": [item("a", price="20.00"), item("b"), item("b", 2), item("c")],
        "payments": [*first["payments"], *second["payments"]],
        "reviews": second["reviews"],
    }
    sources = others | {name: make[name](spark, *some) for name, some in last.items()}
    ordered = lambda frame: sorted(map(tuple, frame.collect()), key=repr)
    for name in make:
        assert ordered(standing(store, s.RAW[name])) == ordered(sources[name]), name
    whole = Store(spark, str(tmp_path / "whole"), buckets=4)
    loads.full_load(whole, sources, LoadWindow("2020-01-02", "2020-01-04", "2020-01-31"))
    for table in (s.FACT_ORDER, s.FACT_PAYMENT, s.FACT_REVIEW):
        assert ordered(loads.latest_facts(store, table, "2020-01-03").drop("dt")) == ordered(whole.read(table, "2020-01-31").drop("dt")) != [], table.name
