"""Snapshots stored as intervals give every snapshot back."""

import random

import pytest
import shop
from pyspark.sql import functions as F
from shop import dec

from orderloom import schemas as s
from orderloom.operators import history
from orderloom.plans import loads
from orderloom.sources.tables import Store


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def _snapshots(rng, days):
    """Payments that come, go, come back, repeat and have no key; some days have none at all."""
    pool = [("a", 1, "x", 1, "1.00"), ("a", None, None, None, None), (None, None, "x", 1, "2.00"), ("b", 1, "y", 2, "3.00"), ("b", 1, "y", 2, "4.00")]
    return {day: [] if n == 3 else [row for row in pool for _ in range(rng.choice((0, 1, 1, 2, 3)))] for n, day in enumerate(days)}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_day_reads_back_as_it_was(spark, tmp_path, seed):
    days = [f"2020-01-{n:02}" for n in (28, 29, 30, 31)] + ["2020-02-01", "2020-02-02"]
    given, store = _snapshots(random.Random(seed), days), Store(spark, str(tmp_path))
    for day, rows in given.items():
        store.overwrite(s.PAYMENTS, shop.payments(spark, *rows), day)
    loads.keep_as_intervals(store, s.PAYMENTS, days)
    kept = store.read(history.history_of(s.PAYMENTS))
    for day, rows in given.items():
        assert _rows(history.as_of(kept, s.PAYMENTS, day)) == _rows(shop.payments(spark, *rows)), day
    # A row that stays has one interval however many days it stays.
    assert kept.groupBy(*s.PAYMENTS.names, "valid_from").count().where(F.col("count") > 3).count() == 0


def test_a_row_that_stays_is_stored_once(spark):
    days = [f"2020-01-{n:02}" for n in range(1, 31)]
    rows = spark.createDataFrame([("a", 1, "x", 1, dec("1.00"), d) for d in days], s.PAYMENTS.stored)
    assert _rows(history.intervals(rows, s.PAYMENTS, days)) == [("a", 1, "x", 1, dec("1.00"), "2020-01-01", None)]
    gap = rows.where("dt <> '2020-01-10'")
    found = {(r.valid_from, r.valid_to) for r in history.intervals(gap, s.PAYMENTS, days).collect()}
    assert found == {("2020-01-01", "2020-01-10"), ("2020-01-11", None)}
