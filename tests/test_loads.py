"""Full and daily load, end to end on the small test tables."""

import pytest
import shop
from shop import item, order

from orderloom import schemas as s
from orderloom.operators import facts, summaries
from orderloom.params import LoadWindow, Select
from orderloom.plans import loads
from orderloom.plans.queries import FULL, QUERIES, present
from orderloom.sources.bindings import raw
from orderloom.sources.tables import Store

SF_DIR = "/root/testdata/sf0.001"
DAY = LoadWindow("1998-06-15", "1998-06-16", "1998-06-16")


@pytest.fixture(scope="module")
def sources(spark):
    return {name: raw(spark, SF_DIR, name) for name in s.RAW}


@pytest.fixture(scope="module")
def full(spark, sources, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("full")))
    loads.full_load(store, sources, FULL)
    return store


def _rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.mark.parametrize(
    "table, key",
    [
        (s.DIM_PRODUCT, "dim_product"),
        (s.FACT_ORDER, "fact_order"),
        (s.FACT_PAYMENT, "fact_payment"),
        (s.FACT_REVIEW, "fact_review"),
        (s.SUM_ORDER_BY_DATE, "sum_order_by_date"),
        (s.SUM_ORDER_BY_CATEGORY, "sum_order_by_category"),
        (s.SUM_ORDER_BY_CUSTOMER_REGION, "sum_order_by_customer_region"),
        (s.SUM_ORDER_BY_SELLER_REGION, "sum_order_by_seller_region"),
        (s.SUM_PAYMENT_BY_DATE, "sum_payment_by_date"),
        (s.SUM_REVIEW_BY_DATE, "sum_review_by_date"),
        (s.SUM_STATUS_BY_DATE, "sum_order_status_by_date"),
    ],
)
def test_full_load_stores_what_the_queries_compute(spark, full, table, key):
    stored = present(full.read(table, FULL.dt).drop("dt"))
    assert _rows(stored) == _rows(QUERIES[key](spark, SF_DIR))


def test_calendar_is_stored_without_days(spark, full):
    assert _rows(full.read(s.DIM_DATE)) == _rows(QUERIES["dim_date"](spark, SF_DIR))


def test_boards_and_quality_are_stored(spark, full):
    assert _rows(present(loads.board(full, FULL.dt))) == _rows(QUERIES["board_daily"](spark, SF_DIR))
    for table in s.BOARDS:
        stored = present(full.read(table, FULL.dt).drop("dt"))
        assert _rows(stored) == _rows(QUERIES[table.name.removesuffix("_1d")](spark, SF_DIR))
    expected = [row for key in ("order", "payment", "review") for row in _rows(QUERIES[f"quality_{key}_rules"](spark, SF_DIR))]
    assert _rows(loads.quality_report(full, FULL.dt)) == sorted(expected, key=repr)
    repeats = full.read(s.QUALITY_DUPLICATES, FULL.dt).drop("dt")
    assert _rows(repeats) == _rows(QUERIES["quality_duplicate_keys"](spark, SF_DIR))


def test_totals_agree_across_layers(full):
    fact = full.read(s.FACT_ORDER)
    amount, orders = fact.selectExpr("sum(total_amount)", "count(distinct order_id)").collect()[0]
    days = full.read(s.SUM_ORDER_BY_DATE)
    gmv, count = days.selectExpr("sum(daily_gmv)", "sum(daily_order_count)").collect()[0]
    assert (gmv, count) == (amount, orders)
    paid = full.read(s.SUM_PAYMENT_BY_DATE).selectExpr("sum(daily_payment_count)").collect()[0][0]
    assert 0 < paid <= full.read(s.FACT_PAYMENT).count()


def test_daily_load_adds_a_day_and_can_run_again(spark, sources, full, tmp_path):
    store = Store(spark, str(tmp_path))
    loads.full_load(store, sources, LoadWindow(FULL.start, DAY.start, DAY.start))
    before = store.read(s.FACT_ORDER).count()
    expected = facts.order(sources["orders"], sources["items"], DAY).count()
    whole = {row["date_id"]: row for row in full.read(s.SUM_ORDER_BY_DATE).drop("dt").collect()}
    for _ in range(2):
        loads.daily_load(store, sources, DAY)
        assert store.read(s.FACT_ORDER, DAY.dt).where(DAY.holds(facts.PURCHASE)).count() == expected
        assert store.read(s.FACT_ORDER, DAY.start).count() == before
        # The day itself, and earlier days whose orders moved on; each as all of history has it.
        days = store.read(s.SUM_ORDER_BY_DATE, DAY.dt).drop("dt").collect()
        assert DAY.start in {row["date_id"] for row in days} and len(days) > 1
        assert all(row == whole[row["date_id"]] for row in days)


def test_append_leaves_two_copies_of_each_row(spark, sources, tmp_path):
    store = Store(spark, str(tmp_path))
    counts = []
    for _ in range(2):
        loads.daily_load(store, sources, DAY, append=True)
        tables = [*loads.INCREMENTS.values(), s.FACT_ORDER, s.FACT_PAYMENT, s.FACT_REVIEW]
        counts.append([store.read(table, DAY.dt).count() for table in tables])
        item_counts = store.read(s.FACT_ORDER, DAY.dt).selectExpr("max(item_count)").first()[0]
        counts[-1].append(item_counts)
    assert counts[1][:-1] == [2 * n for n in counts[0][:-1]] and counts[1][-1] == counts[0][-1]


SUMMARY_KEYS = {
    s.SUM_ORDER_BY_DATE: "sum_order_by_date",
    s.SUM_ORDER_BY_CATEGORY: "sum_order_by_category",
    s.SUM_ORDER_BY_CUSTOMER_REGION: "sum_order_by_customer_region",
    s.SUM_ORDER_BY_SELLER_REGION: "sum_order_by_seller_region",
    s.SUM_PAYMENT_BY_DATE: "sum_payment_by_date",
    s.SUM_REVIEW_BY_DATE: "sum_review_by_date",
    s.SUM_STATUS_BY_DATE: "sum_order_status_by_date",
}


def test_a_full_load_after_other_loads_counts_everything_once(spark, sources, full, tmp_path):
    store = Store(spark, str(tmp_path))
    loads.full_load(store, sources, LoadWindow(FULL.start, FULL.end, "2001-12-31"))
    loads.daily_load(store, sources, DAY)
    loads.full_load(store, sources, FULL)
    for table in SUMMARY_KEYS:
        assert _rows(store.read(table, FULL.dt)) == _rows(full.read(table, FULL.dt)), table.name


def _shop(spark, orders, items, **more):
    named = {
        "orders": shop.orders(spark, *orders),
        "items": shop.items(spark, *items),
        "payments": shop.payments(spark, *more.get("payments", [])),
    }
    return {name: named.get(name, spark.createDataFrame([], table.schema)) for name, table in s.RAW.items()}


def _day(n):
    return LoadWindow(f"2020-01-{n:02}", f"2020-01-{n + 1:02}", f"2020-01-{n:02}")


def test_a_later_delivery_changes_the_day_of_purchase(spark, tmp_path):
    store, items = Store(spark, str(tmp_path)), [item("a"), item("b")]
    late = {"promised": "2020-01-05"}
    loads.daily_load(store, _shop(spark, [order("a", bought="2020-01-02", **late), order("b", bought="2020-01-02", **late)], items), _day(2))
    day = loads.latest_by_day(store.read(s.SUM_ORDER_BY_DATE)).first()
    assert (day["daily_order_count"], day["avg_total_duration"], float(day["overtime_rate"])) == (2, None, 0.0)
    loads.daily_load(store, _shop(spark, [order("a", bought="2020-01-02", received="2020-01-08", **late), order("b", bought="2020-01-02", **late)], items), _day(8))
    (day,) = loads.latest_by_day(store.read(s.SUM_ORDER_BY_DATE)).collect()
    assert (day["date_id"], day["daily_order_count"], float(day["avg_total_duration"]), float(day["overtime_rate"])) == ("2020-01-02", 2, 6.0, 0.5)
    assert store.read(s.SUM_ORDER_BY_DATE, "2020-01-02").first()["avg_total_duration"] is None


def test_a_returning_customer_is_not_new(spark, tmp_path):
    store, items = Store(spark, str(tmp_path)), [item("a"), item("b"), item("c")]
    orders = [order("a", customer="x", bought="2020-01-02"), order("b", customer="x", bought="2020-01-03"), order("c", customer="y", bought="2020-01-03")]
    sources = _shop(spark, orders, items)
    for n in (2, 3, 3):
        loads.daily_load(store, sources, _day(n))
    rates = {row["date_id"]: float(row["new_customer_rate"]) for row in loads.latest_by_day(store.read(s.SUM_ORDER_BY_DATE)).collect()}
    assert rates == {"2020-01-02": 1.0, "2020-01-03": 0.5}
    by_seller = store.read(s.SUM_ORDER_BY_SELLER_REGION, "2020-01-03").collect()
    assert [float(row["region_new_customer_rate"]) for row in by_seller] == [0.5]


def test_a_payment_that_comes_after_its_order_is_counted(spark, tmp_path):
    store, orders, items = Store(spark, str(tmp_path)), [order("a", bought="2020-01-02")], [item("a")]
    first = [("a", 1, "voucher", 1, "1.00")]
    loads.daily_load(store, _shop(spark, orders, items, payments=first), _day(2))
    loads.daily_load(store, _shop(spark, orders, items, payments=[*first, ("a", 2, "voucher", 1, "2.00")]), _day(3))
    late = {(row["dt"], row["table_name"]): row["failed_rows"] for row in store.read(s.QUALITY_RULES).where("rule = 'not loaded with its order'").collect()}
    assert late == {("2020-01-02", "payments"): 0, ("2020-01-02", "items"): 0, ("2020-01-03", "payments"): 1, ("2020-01-03", "items"): 0}


def test_regions_keep_orders_of_unknown_customers_and_sellers(spark):
    orders = [order("a", customer="known"), order("b", customer="other"), order("c", customer="other")]
    fact = facts.order(shop.orders(spark, *orders), shop.items(spark, *[item(o) for o in "abc"]), LoadWindow("2020-01-01", "2020-02-01", "x"))
    total = fact.selectExpr("sum(total_amount)").first()[0]
    customers = spark.createDataFrame([("known", "S", "C")], "customer_id string, customer_state string, customer_city string")
    sellers = spark.createDataFrame([], "seller_id string, seller_state string, seller_city string")
    for found in (summaries.order_by_customer_region(fact, customers, Select.all()), summaries.order_by_seller_region(fact, sellers, Select.all())):
        assert found.selectExpr("sum(region_gmv)").first()[0] == total


def test_a_daily_load_copies_only_what_it_is_told(spark, sources, tmp_path):
    store = Store(spark, str(tmp_path))
    loads.daily_load(store, sources, DAY, copies=())
    assert not any(store.has(table) for table in s.RAW.values())
    assert store.read(s.FACT_ORDER, DAY.dt).count() > 0
    payments = summaries.payment_by_date(store.read(s.FACT_PAYMENT), store.read(s.FACT_ORDER, DAY.dt), Select.partition(DAY.dt))
    plan = payments._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(dt") >= 2 and "PartitionFilters: []" not in plan


def test_daily_reviews_find_orders_bought_earlier(spark, sources, full, tmp_path):
    created = {row["date_id"]: row["count"] for row in full.read(s.FACT_REVIEW).groupBy("date_id").count().collect()}
    day = max(created)
    nxt = spark.sql(f"select cast(date_add(date'{day}', 1) as string)").collect()[0][0]
    store = Store(spark, str(tmp_path))
    loads.full_load(store, sources, LoadWindow(FULL.start, day, day))
    loads.daily_load(store, sources, LoadWindow(day, nxt, nxt))
    assert store.read(s.FACT_REVIEW, nxt).count() == created[day]


def test_select_keeps_modes_apart(full):
    fact = full.read(s.FACT_ORDER)
    assert Select.partition("1900-01-01")(fact, facts.PURCHASE).count() == 0
    assert Select.between(FULL)(fact, facts.PURCHASE).count() == fact.count()
