"""What loads find changed: differences of snapshots, late rows, and any sequence of daily loads against one full load."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
import shop
from shop import at, dec, item, order

from orderloom import schemas as s
from orderloom.operators import changes, facts
from orderloom.params import LoadWindow
from orderloom.plans import loads
from orderloom.sources.tables import Store


def day(n):
    return LoadWindow(f"2020-01-{n:02}", f"2020-01-{n + 1:02}", f"2020-01-{n:02}")


def sources(spark, orders=(), items=(), payments=(), reviews=()):
    named = {
        "orders": shop.orders(spark, *orders),
        "items": shop.items(spark, *items),
        "payments": shop.payments(spark, *payments),
        "reviews": shop.reviews(spark, *reviews),
    }
    return {name: named.get(name, spark.createDataFrame([], table.schema)) for name, table in s.RAW.items()}


class Town:
    """A shop that lives for some days: orders come, late ones too; rows of any kind change, repeat, vanish or come after their order."""

    def __init__(self, seed):
        self.rng = random.Random(seed)
        self.orders, self.items, self.payments, self.reviews = {}, [], [], []
        self.n = 0

    def some(self, *values):
        return self.rng.choice(values)

    def price(self):
        return self.some(None, "-1.00", *[f"{self.rng.randrange(10000) / 100:.2f}" for _ in range(8)])

    def buy(self, n):
        bought = datetime(2020, 1, n) + timedelta(hours=self.rng.randrange(24))
        name = f"o{self.n}"
        self.n += 1
        self.orders[name] = [self.some(None, *[f"c{k}" for k in range(6)]), self.some("created", "shipped", "canceled", None), bought, None, None]
        for k in range(self.rng.randrange(4)):
            self.items.append([name, self.some(None, k, 1), self.some("p0", "p1"), "s", self.price(), "1.00"])
        for _ in range(self.rng.randrange(3)):
            self.pay(name)

    def pay(self, name):
        self.payments.append([name, self.some(None, 0, 1, 2), "card", self.some(0, 1, 3), self.price()])

    def review(self, n):
        name = self.some(*self.orders)
        created = datetime(2020, 1, n) + timedelta(hours=self.rng.randrange(24))
        self.reviews.append([f"r{self.rng.randrange(8)}", name, self.some(None, 1, 4, 5), self.some(None, "text"), created, None])

    def live(self, n):
        """Day ``n``: what is there by its end, all of it in no order of its own."""
        for _ in range(6):
            self.buy(n)
        for _ in range(2):
            self.buy(self.rng.randrange(2, n + 1))
        for _ in range(5):
            self.review(n)
        for _ in range(3):
            self.pay(self.some(*self.orders))
            self.items.append([self.some(*self.orders), 9, "p1", "s", "3.00", "0.50"])
            self.payments.append(list(self.some(*self.payments)))
        for name in self.rng.sample(sorted(self.orders), 3):
            self.orders[name][1] = self.some("canceled", "delivered", None)
        for name in self.rng.sample(sorted(self.orders), 3):
            self.orders[name][3:5] = [datetime(2020, 1, n), datetime(2020, 1, n) + timedelta(hours=5)]
        for name in self.rng.sample(sorted(self.orders), 2):
            self.orders[name][0] = self.some("c0", "c9")
        for rows, column in ((self.items, 4), (self.payments, 4), (self.reviews, 2)):
            changed = self.some(*rows)
            changed[column] = self.price() if column == 4 else 5
            rows.pop(self.rng.randrange(len(rows)))
        self.some(*self.reviews)[5] = datetime(2020, 1, n, 20)
        gone = self.some(*self.orders)
        if self.rng.random() < 0.5:
            del self.orders[gone]

    def sources(self, spark):
        text = lambda t: t and str(t)
        orders = [(o, c, st, str(b), text(ca), text(cu), "2020-01-05") for o, (c, st, b, ca, cu) in self.orders.items()]
        reviews = [(r, o, sc, m, str(c), text(a)) for r, o, sc, m, c, a in self.reviews]
        return sources(spark, orders, map(tuple, self.items), map(tuple, self.payments), reviews)


FACTS = (s.FACT_ORDER, s.FACT_PAYMENT, s.FACT_REVIEW)
BY_DAY = (s.SUM_ORDER_BY_DATE, s.SUM_PAYMENT_BY_DATE, s.SUM_REVIEW_BY_DATE, s.SUM_STATUS_BY_DATE)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("seed, quick", [(2, (4,))])
def test_daily_loads_end_where_a_full_load_of_the_last_sources_does(spark, tmp_path, seed, quick):
    """A load that does not reconcile may stand between; the next one that does finds what it missed."""
    town, store, last = Town(seed), Store(spark, str(tmp_path / "daily"), buckets=4), 5
    for n in range(2, last + 1):
        town.live(n)
        current = town.sources(spark)
        if n == 3:
            loads.full_load(store, current, LoadWindow("2020-01-02", "2020-01-04", "2020-01-03"))
        else:
            loads.daily_load(store, current, day(n), copies=(), reconcile=n not in quick)
    loads.daily_load(store, current, day(last), copies=())  # a repeated run changes nothing
    whole = Store(spark, str(tmp_path / "full"), buckets=4)
    loads.full_load(whole, current, LoadWindow("2020-01-02", f"2020-01-{last + 1:02}", "2020-01-31"))
    for table in FACTS:
        found = loads.latest_facts(store, table, day(last).dt)
        assert rows(found.drop("dt")) == rows(whole.read(table, "2020-01-31").drop("dt")), table.name
    for table in BY_DAY:
        found = loads.latest_by_day(store.read(table))
        assert rows(found) == rows(whole.read(table, "2020-01-31").drop("dt")), table.name
    repeats = store.read(s.QUALITY_DUPLICATES, day(last).dt).drop("dt")
    assert rows(repeats) == rows(whole.read(s.QUALITY_DUPLICATES, "2020-01-31").drop("dt")) != []


def test_a_cancelled_order_leaves_its_day(spark, tmp_path):
    store, items = Store(spark, str(tmp_path)), [item("a"), item("b"), item("c")]
    bought = {"bought": "2020-01-02 10:00:00"}
    loads.daily_load(store, sources(spark, [order("a", **bought), order("b", **bought)], items), day(2), copies=())
    newest = lambda: loads.latest_by_day(store.read(s.SUM_ORDER_BY_DATE)).select("date_id", "daily_order_count", "daily_gmv").collect()
    assert [tuple(r) for r in newest()] == [("2020-01-02", 2, dec("22.00"))]
    loads.daily_load(store, sources(spark, [order("a", **bought), order("b", status="canceled", **bought)], [item("a", price="12.00"), item("b")]), day(3), copies=())
    assert [tuple(r) for r in newest()] == [("2020-01-02", 1, dec("13.00"))]
    # The last one goes as well: the day counts nothing in this load, and has no newest row.
    loads.daily_load(store, sources(spark, [order("b", status="canceled", **bought)], []), day(4), copies=())
    assert newest() == [] and store.read(s.SUM_ORDER_BY_DATE, "2020-01-04").first()["daily_order_count"] == 0
    found = {(r.order_id, r.dt): r.change for r in store.read(s.ORDER_STATE).collect()}
    assert found == {("a", "2020-01-02"): "inserted", ("b", "2020-01-02"): "inserted", ("c", "2020-01-02"): "inserted", ("a", "2020-01-03"): "changed",
                     ("b", "2020-01-03"): "changed", ("c", "2020-01-03"): "removed", ("a", "2020-01-04"): "removed", ("b", "2020-01-04"): "changed"}


def test_a_payment_that_is_two_days_late_after_a_full_load(spark, tmp_path):
    store, orders, items = Store(spark, str(tmp_path)), [order("a", bought="2020-01-02 10:00:00")], [item("a")]
    first, late = ("a", 1, "voucher", 1, "1.00"), ("a", 2, "voucher", 1, "2.00")
    unnumbered = ("a", None, "voucher", 1, "7.00")
    loads.full_load(store, sources(spark, orders, items, [first, unnumbered]), LoadWindow("2020-01-01", "2020-01-03", "2020-01-02"))
    paid = lambda: loads.latest_by_day(store.read(s.SUM_PAYMENT_BY_DATE)).select("date_id", "daily_payment_value", "daily_payment_count").collect()
    for n, payments in ((3, [first, unnumbered]), (4, [first, unnumbered, late]), (5, [late, unnumbered, first])):
        loads.daily_load(store, sources(spark, orders, items, payments), day(n), copies=())
        counted = {r.table_name: r.failed_rows for r in store.read(s.QUALITY_RULES, day(n).dt).where("rule = 'not loaded with its order'").collect()}
        assert counted == {"payments": int(n == 4), "items": 0}
    assert [tuple(r) for r in paid()] == [("2020-01-02", dec("3.00"), 2)]
    assert loads.latest_facts(store, s.FACT_PAYMENT, "2020-01-05").count() == 2


def test_a_first_order_that_is_cancelled_makes_the_next_one_the_first(spark, tmp_path):
    store, items = Store(spark, str(tmp_path)), [item("a"), item("b")]
    second = order("b", customer="x", bought="2020-01-03 10:00:00")
    first = lambda status: order("a", customer="x", status=status, bought="2020-01-02 10:00:00")
    loads.daily_load(store, sources(spark, [first("created")], items[:1]), day(2), copies=())
    loads.daily_load(store, sources(spark, [first("created"), second], items), day(3), copies=())
    loads.daily_load(store, sources(spark, [first("canceled"), second], items), day(4), copies=())
    rates = {r.date_id: float(r.new_customer_rate) for r in loads.latest_by_day(store.read(s.SUM_ORDER_BY_DATE)).collect()}
    assert rates == {"2020-01-03": 1.0}


def test_difference_counts_rows_of_null_and_repeated_keys(spark):
    before = [("a", 1, "x", 1, "1.00"), ("a", 1, "x", 1, "1.00"), ("a", None, "x", 1, "1.00"), (None, None, "x", 1, "1.00"), ("b", 1, None, None, "1.00"), ("c", 1, "x", 1, "1.00")]
    now = [("a", 1, "x", 1, "1.00"), ("a", None, "x", 1, "1.00"), (None, None, "x", 1, "1.00"), (None, None, "x", 1, "1.00"), ("b", 1, None, 1, None), ("d", 2, "x", 1, "1.00"), ("c", 1, "x", 1, "1.00")]
    old, new = shop.payments(spark, *before), shop.payments(spark, *now)
    found = {tuple(r) for r in changes.difference(old, new, s.PAYMENTS).collect()}
    assert found == {("a", 1, "changed", 2, 1), (None, None, "changed", 1, 2), ("b", 1, "changed", 1, 1), ("d", 2, "inserted", 0, 1)}
    assert {r.order_id: r.change for r in changes.difference(new, old, s.PAYMENTS).collect() if r.order_id == "d"} == {"d": "removed"}
    missing = Counter(map(tuple, changes.surplus(new, old, s.PAYMENTS).collect()))
    assert missing == Counter({(o, k, t, p, dec(v)): 1 for o, k, t, p, v in ((None, None, "x", 1, "1.00"), ("b", 1, None, 1, None), ("d", 2, "x", 1, "1.00"))})


def test_values_that_move_between_empty_columns_are_seen(spark):
    one = [("r", "a", 1, None, "2020-01-01", None)]
    moved = [("r", "a", 1, None, None, "2020-01-01")]
    assert changes.difference(shop.reviews(spark, *one), shop.reviews(spark, *moved), s.REVIEWS).count() == 1


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def loaded(spark, tmp_path):
    """Three months by a full load, then a day that changes one order of February."""
    store = Store(spark, str(tmp_path), buckets=4)
    orders = [order(f"o{n}", customer=f"c{n}", bought=str(datetime(2020, 1, 1) + timedelta(days=n))) for n in range(90)]
    items = [item(f"o{n}") for n in range(90)]
    reviews = [(f"r{n}", f"o{n}", 5, "t", str(datetime(2020, 1, 3) + timedelta(days=n)), None) for n in range(90)]
    loads.full_load(store, sources(spark, orders, items, (), reviews), LoadWindow("2020-01-01", "2020-04-15", "2020-04-14"))
    orders[40] = order("o40", customer="c40", status="canceled", bought=str(datetime(2020, 1, 1) + timedelta(days=40)))
    loads.daily_load(store, sources(spark, orders, items, (), reviews), LoadWindow("2020-04-15", "2020-04-16", "2020-04-15"), copies=())
    return store


def test_a_day_reads_only_the_months_it_touches(spark, loaded):
    days = loaded.read(s.TOUCHED_DAYS, "2020-04-15")
    assert {(r["source"], r.date_id) for r in days.collect()} == {("orders", "2020-02-10"), ("reviews", "2020-02-12")}
    assert {path.split("month=")[1][:7] for path in loaded.read(s.FACT_ORDER).inputFiles()} == {"2020-01", "2020-02", "2020-03"}
    found = loads._rows_of_days(loaded, s.FACT_ORDER, days.where("source = 'orders'"), "2020-04-15", "2020-04-14")
    assert re.search(r"PartitionFilters: \[[^]]*month#\d+ = 2020-02", _plan(found)), _plan(found)
    assert found.count() == 0  # the only order of that day is void now


def test_what_loads_remember_is_not_shuffled(spark, loaded):
    """Nothing between the stored state and the join that uses it moves its rows."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some = sources(spark, [order("o1")], [item("o1")])
        window = LoadWindow("2020-01-01", "2020-04-16", "2020-04-16")
        differing = changes.touched(changes.bundles(some, window), loads.state(loaded, "2020-04-15"), loaded.buckets)
        existing = loads._exist(loaded, loaded.read(s.FACT_REVIEW, "2020-04-15"), "2020-04-15")
        first = loads.first_days(loaded, "2020-04-15")
        for frame in (differing, existing, first):
            lines = _plan(frame).split("\n")
            for n, line in enumerate(lines):
                if "FileScan orc" in line and ("order_state" in line or "first_purchase" in line):
                    depth, above = line.index("FileScan"), []
                    for up in reversed(lines[:n]):
                        mark = len(up) - len(up.lstrip(" :+-"))
                        if mark < depth:
                            depth = mark
                            above.append(up.strip(" :+-"))
                    assert above and not any(a.startswith("Exchange") for a in above), "\n".join(above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_replaced_calendar_stays_when_the_write_fails(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    calendar = spark.createDataFrame([("2020-01-01", 2020, 1, 1, 1, 0)], s.DIM_DATE.schema)
    store.replace(s.DIM_DATE, calendar)
    broken = calendar.selectExpr("raise_error(date_id) as date_id", "year", "quarter", "month", "day", "is_weekend").selectExpr("cast(date_id as string) date_id", "year", "quarter", "month", "day", "is_weekend")
    with pytest.raises(Exception, match="2020-01-01"):
        store.replace(s.DIM_DATE, broken)
    assert store.read(s.DIM_DATE).count() == 1
    fact = facts.order(shop.orders(spark, order("a")), shop.items(spark, item("a")), LoadWindow("2020-01-01", "2020-02-01", "x"))
    store.overwrite(s.FACT_ORDER, fact, "2020-01-10")
    with pytest.raises(Exception, match="bad"):
        store.overwrite(s.FACT_ORDER, fact.selectExpr("* except (date_id)", "raise_error('bad') as date_id").selectExpr("* except (date_id)", "cast(date_id as string) as date_id"), "2020-01-10")
    assert store.read(s.FACT_ORDER, "2020-01-10").count() == 1
    assert [r.month for r in spark.read.orc(store.path(s.FACT_ORDER)).select("month").collect()] == ["2020-01"]
    assert at("2020-01-01")
