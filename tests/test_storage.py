"""Raw readers, dated tables and load modes."""

import csv
import io
import random
from datetime import datetime, timedelta

import duckdb
import pytest
import shop
from pyspark.sql import functions as F
from shop import JANUARY, item, order

from orderloom import schemas as s
from orderloom.operators import ods
from orderloom.params import LoadWindow
from orderloom.sources import raw
from orderloom.sources.tables import Store, scratch_store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def _days(rows):
    return {row["dt"]: row["count"] for row in rows.groupBy("dt").count().collect()}


def test_overwrite_replaces_one_day(spark, store):
    two = shop.orders(spark, order("a"), order("b"))
    store.overwrite(s.ORDERS, two, "2020-01-01")
    for _ in range(2):
        store.overwrite(s.ORDERS, two, "2020-01-02")
    assert _days(store.read(s.ORDERS)) == {"2020-01-01": 2, "2020-01-02": 2}
    store.overwrite(s.ORDERS, two.where("order_id = 'a'"), "2020-01-02")
    assert _days(store.read(s.ORDERS)) == {"2020-01-01": 2, "2020-01-02": 1}
    store.overwrite(s.ORDERS, two.where("false"), "2020-01-02")
    assert _days(store.read(s.ORDERS)) == {"2020-01-01": 2}


def test_registered_tables_answer_sql(spark, store):
    store.overwrite(s.ORDERS, shop.orders(spark, order("a"), order("b")), "2020-01-01")
    store.register(s.ORDERS)
    found = spark.sql("select dt, count(*) from ods_orders_df group by dt").collect()
    assert [tuple(row) for row in found] == [("2020-01-01", 2)]


def test_append_adds(spark, store):
    one = shop.orders(spark, order("a"))
    for _ in range(2):
        store.append(s.ORDERS, one, "2020-01-01")
    assert _days(store.read(s.ORDERS)) == {"2020-01-01": 2}


def test_a_failing_write_leaves_the_old_day(spark, store):
    store.overwrite(s.ORDERS, shop.orders(spark, order("a"), order("b")), "2020-01-01")
    broken = shop.orders(spark, order("c")).withColumn("customer_id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        store.overwrite(s.ORDERS, broken, "2020-01-01")
    assert _days(store.read(s.ORDERS)) == {"2020-01-01": 2}


def test_a_table_that_only_ever_got_empty_days_can_be_read(spark, store):
    assert not store.has(s.ORDERS)
    store.overwrite(s.ORDERS, shop.orders(spark, order("a")).where("false"), "2020-01-01")
    assert store.has(s.ORDERS) and store.read(s.ORDERS).count() == 0


def _random_reviews(rng, n):
    """Reviews whose texts hold line breaks, quotes and commas, as a CSV writer puts them."""
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(("\n", "\r\n")))
    writer.writerow(s.REVIEWS.names)
    for k in range(n):
        text = "".join(rng.choice(['"', "\n", ",", "a", "é", " ", "\n\n", '""', "word"]) for _ in range(rng.choice((0, 3, 40, 400))))
        writer.writerow([f"r{k}", f"o{k % 7}", rng.choice(("", 1, 5)), rng.choice(("", "title", 'a "title"\n')), text, "2020-01-05 10:11:12", rng.choice(("", "2020-01-06 00:00:00"))])
    return out.getvalue()


@pytest.mark.parametrize("split", [64, 1_000, 1 << 20])
def test_quoted_line_breaks_are_read_in_parallel(spark, tmp_path, split):
    """Equal rows to the read in one task, however the splits cut through records."""
    rng, schema = random.Random(split), s.REVIEWS.schema
    for n, rows in enumerate((60, 1, 0, 25)):
        (tmp_path / f"{n}.csv").write_bytes(_random_reviews(rng, rows).encode())
    path = str(tmp_path)
    whole = spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', mode="FAILFAST")
    for key, value in {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}.items():
        spark.conf.set(key, value)
    try:
        found = raw.csv(spark, path, s.REVIEWS, line_breaks=True)
        assert found.schema.simpleString() == schema.simpleString()
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_other_columns_in_a_file_with_line_breaks_raise(spark, tmp_path):
    (tmp_path / "x.csv").write_text('"category_name_pt","other"\n"a\nb",c\n')
    with pytest.raises(Exception, match="has columns"):
        raw.csv(spark, str(tmp_path / "x.csv"), s.TRANSLATION, line_breaks=True).collect()


def test_slices_of_equal_depth():
    """The query's SQL runs in DuckDB here; a third of all rows are bought at one instant, most others on one day."""
    rng, duck = random.Random(4), duckdb.connect()
    start = datetime(2020, 1, 1)
    times = [start + timedelta(hours=12)] * 300 + [start + timedelta(days=9, seconds=rng.randrange(80_000)) for _ in range(500)]
    times += [start + timedelta(seconds=rng.randrange(31 * 86_400)) for _ in range(100)] + [start - timedelta(days=1), start + timedelta(days=40)]
    duck.execute("create table sales (bought timestamp)")
    duck.executemany("insert into sales values (?)", [[t] for t in times])
    lows = [low for _, low in duck.execute(raw.depth_query("sales", "bought", JANUARY, 9)).fetchall()]
    counts = [duck.execute(f"select count(*) from sales where {p}").fetchone()[0] for p in raw.depth_slices(JANUARY, "bought", lows)]
    assert sum(counts) == 900 and len(counts) > 5
    assert max(counts) <= 400 and sorted(counts)[-2] <= 101
    assert [duck.execute(f"select count(*) from sales where {p}").fetchone()[0] for p in raw.depth_slices(JANUARY, "bought", [])] == [900]


def test_database_rows_get_the_declared_types(monkeypatch, spark):
    """The reader alone: no database here."""
    given = spark.sql("select 'o' as order_id, 2L as payment_sequential, 'x' as payment_type, '3' as payment_installments, 1.5D as payment_value")
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, predicates, properties: given)
    rows = raw.jdbc_window(spark, "url", "payments", s.PAYMENTS, "t", JANUARY, 2, {})
    assert rows.dtypes == spark.createDataFrame([], s.PAYMENTS.schema).dtypes


def test_written_types_come_back(spark, store):
    rows = shop.items(spark, item("a", price="12.30"))
    store.overwrite(s.ITEMS, rows, "2020-01-01")
    back = store.read(s.ITEMS)
    assert back.dtypes == spark.createDataFrame([], s.ITEMS.stored).dtypes
    assert back.drop("dt").collect() == rows.collect()


def test_day_is_pruned_and_window_is_pushed(spark, store):
    store.overwrite(s.ORDERS, shop.orders(spark, order("a")), "2020-01-01")
    rows = store.read(s.ORDERS, "2020-01-01").where(JANUARY.holds("order_purchase_timestamp")).select("order_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan
    assert "ReadSchema: struct<order_id:string,order_purchase_timestamp:timestamp_ntz>" in plan


def test_files_are_orc_with_snappy(spark, store, tmp_path):
    store.overwrite(s.ORDERS, shop.orders(spark, order("a")), "2020-01-01")
    files = list((tmp_path / "ods_orders_df" / "dt=2020-01-01").glob("*.orc"))
    assert files and all(f.name.endswith(".snappy.orc") for f in files)


def test_comments_travel_with_the_schema(spark):
    fields = {f.name: f.metadata["comment"] for f in s.FACT_ORDER.conform(
        spark.createDataFrame([], s.FACT_ORDER.schema)).schema.fields}
    assert fields["deliver_duration"] == "days from carrier to customer"


def test_a_value_that_does_not_fit_raises(spark, store):
    too_long = spark.createDataFrame([("o", 2**40, "x", 1, None)], "order_id string, payment_sequential bigint,"
                                     " payment_type string, payment_installments int, payment_value decimal(10,2)")
    with pytest.raises(Exception, match="(?i)overflow"):
        s.PAYMENTS.conform(too_long).collect()


def test_csv_with_header(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        'review_id,order_id,review_score,review_comment_title,review_comment_message,'
        'review_creation_date,review_answer_timestamp\n'
        'r1,o1,5,,"two\nlines, ""quoted""",2020-01-05 00:00:00,2020-01-06 10:11:12\n'
        "r2,o2,1,,,2020-01-05 00:00:00,\n"
    )
    first, second = raw.csv(spark, str(path), s.REVIEWS, line_breaks=True).orderBy("review_id").collect()
    assert first["review_comment_message"] == 'two\nlines, "quoted"'
    assert (first["review_score"], first["review_answer_timestamp"]) == (5, shop.at("2020-01-06 10:11:12"))
    assert (second["review_comment_message"], second["review_answer_timestamp"]) == (None, None)


def test_csv_with_other_columns_raises(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\ns1,lima,01000,SP\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.csv(spark, str(path), s.SELLERS).collect()


def test_headerless_csv_is_named_by_position(spark, tmp_path):
    path = tmp_path / "translation.csv"
    path.write_text("moveis,furniture\nluz,light\n")
    source = raw.headerless_csv(spark, str(path), s.TRANSLATION)
    assert source.columns == ["col_1", "col_2"]
    rows = ods.snapshot(ods.positional(source, s.TRANSLATION), s.TRANSLATION, "2020-01-01").collect()
    assert sorted(tuple(r) for r in rows) == [("luz", "light", "2020-01-01"), ("moveis", "furniture", "2020-01-01")]


def test_parquet_source_is_conformed(spark, tmp_path):
    path = str(tmp_path / "items")
    shop.items(spark, item("a")).selectExpr("'extra' as extra", "*").write.parquet(path)
    assert raw.parquet(spark, path, s.ITEMS).columns == s.ITEMS.names


def test_text_columns_are_parsed(spark):
    text = [("o1", "1", "p", "s", "2020-01-05 10:00:00", "58.9", "3")]
    spark.createDataFrame(text, s.ITEMS.names).createOrReplaceTempView("loose_items")
    found = raw.catalog(spark, "loose_items", s.ITEMS)
    assert found.dtypes == spark.createDataFrame([], s.ITEMS.schema).dtypes
    assert tuple(found.collect()[0])[1:2] + tuple(found.collect()[0])[4:] == (
        1, shop.at("2020-01-05 10:00:00"), shop.dec("58.90"), shop.dec("3.00"))
    with pytest.raises(Exception, match="(?i)cast"):
        raw.typed(spark.table("loose_items").selectExpr("* except (price)", "'dear' as price"), s.ITEMS).collect()


def test_window_slices_cover_the_window_once(spark):
    window = LoadWindow("2020-01-01", "2020-01-02", "2020-01-02")
    slices = raw.window_slices(window, "t", 7)
    assert len(slices) == 7
    times = spark.range(0, 24 * 60 + 1).selectExpr(
        "timestamp_ntz '2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, int(id)) as t"
    )
    hits = times.selectExpr("t", " + ".join(f"int({one})" for one in slices) + " as n")
    assert hits.where(window.holds("t") & (hits.n != 1)).count() == 0
    assert hits.where(~window.holds("t") & (hits.n != 0)).count() == 0


def test_increments(spark):
    orders = shop.orders(spark, order("in", bought="2020-01-01"), order("out", bought="2020-02-01"))
    taken = ods.append_window(orders, s.ORDERS, "order_purchase_timestamp", JANUARY)
    assert [(r["order_id"], r["dt"]) for r in taken.collect()] == [("in", "2020-02-01")]
    items = shop.items(spark, item("in", 1), item("in", 2), item("out"), item("lost"))
    lines = ods.append_of_orders(items, s.ITEMS, taken, JANUARY.dt).collect()
    assert sorted((r["order_id"], r["order_item_id"]) for r in lines) == [("in", 1), ("in", 2)]


class _Session:
    """Stands in for a session, whose checkpoint folder can only be set when it starts."""

    def __init__(self, master, shared=None):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_follows_the_shared_folder():
    session = _Session("spark://cluster:7077", "hdfs://shared/tmp/")
    first, second = scratch_store(session), scratch_store(session)
    assert first.root.startswith("hdfs://shared/tmp/orderloom-") and first.root != second.root


def test_scratch_without_shared_folder_lies_in_the_warehouse():
    session = _Session("spark://cluster:7077")
    session.conf["spark.sql.warehouse.dir"] = "hdfs://warehouse"
    assert scratch_store(session).root.startswith("hdfs://warehouse/orderloom-")


def test_scratch_on_the_drivers_disk_is_refused_on_a_cluster():
    for master, refused in (("spark://cluster:7077", True), ("yarn", True), ("local[4]", False)):
        session = _Session(master)
        session.conf["spark.sql.warehouse.dir"] = "file:/home/me/spark-warehouse"
        if refused:
            with pytest.raises(ValueError, match="checkpoint.dir"):
                scratch_store(session)
        else:
            assert scratch_store(session).root.startswith("file:/home/me")


def test_scratch_can_be_removed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "scratch"))
    store.append(s.ORDERS, shop.orders(spark, order("a")), "d")
    store.remove()
    assert not (tmp_path / "scratch").exists()
