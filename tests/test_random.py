"""Summaries of random shops against a plain Python count of the same rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
import shop
from shop import JANUARY, by

from orderloom.functions.columns import VOID_STATUSES
from orderloom.operators import dims, facts, summaries
from orderloom.params import Select

ALL = Select.between(JANUARY)


class Shop:
    """Orders over two months, with missing values everywhere and one order that holds a third of all items."""

    def __init__(self, seed):
        rng = random.Random(seed)
        some = lambda *values: rng.choice(values)
        start = datetime(2019, 12, 20)
        self.orders, self.items, self.payments, self.reviews = [], [], [], []
        for n in range(60):
            bought = start + timedelta(hours=rng.randrange(24 * 50))
            carrier = bought + timedelta(hours=rng.randrange(100)) if rng.random() < 0.8 else None
            received = carrier + timedelta(hours=rng.randrange(300)) if carrier and rng.random() < 0.8 else None
            status = some("delivered", "shipped", "created", "canceled", "unavailable", None)
            customer = some(None, *[f"c{k}" for k in range(12)])
            self.orders.append((f"o{n}", customer, status, str(bought), carrier and str(carrier),
                                received and str(received), str(bought + timedelta(days=7))))
            for k in range(90 if n == 7 else rng.randrange(6)):
                price = some(None, "-1.00", f"{rng.randrange(10000) / 100:.2f}", f"{rng.randrange(10000) / 100:.2f}")
                self.items.append((f"o{n}", k, some("p0", "p1", "p2", "p3", "gone"), "s", price, some("0.00", "1.11")))
            for k in range(rng.randrange(4)):
                value = some(None, "0.00", f"{rng.randrange(5000) / 100:.2f}")
                self.payments.append((f"o{n}", k, "card", some(0, 1, 2, 5), value))
            if rng.random() < 0.7:
                created = bought + timedelta(days=rng.randrange(12))
                answered = created + timedelta(minutes=rng.randrange(4000)) if rng.random() < 0.6 else None
                self.reviews.append((f"r{n}", f"o{n}", some(None, 0, 1, 2, 3, 4, 5), some(None, "", "text"),
                                     str(created), answered and str(answered)))
        self.categories = {"p0": "a", "p1": "b", "p2": "a", "p3": None}

    def sound_orders(self):
        inside = {o[0]: o for o in self.orders if JANUARY.start <= o[3] < JANUARY.end}
        return {k: o for k, o in inside.items() if o[2] is not None and o[2] not in VOID_STATUSES}

    def fact(self):
        """(order, product, amount) of the sound items."""
        sound = self.sound_orders()
        return [(sound[o], p, Decimal(price) + Decimal(freight)) for o, _, p, _, price, freight in self.items
                if o in sound and price is not None and Decimal(price) >= 0]


def rounded(part, count, places):
    if not count:
        return None
    return (Decimal(part) / Decimal(count)).quantize(Decimal(10) ** -places, ROUND_HALF_UP)


def days(start, end):
    if not start or not end:
        return None
    return (datetime.fromisoformat(end).date() - datetime.fromisoformat(start).date()).days


def mean(values, places=2):
    values = [v for v in values if v is not None]
    return rounded(sum(values), len(values), places)


def order_metrics(rows):
    """The ten metrics by key from (key, order, amount) rows."""
    first = {}
    for _, order, _ in rows:
        day = order[3][:10]
        first[order[1]] = min(day, first.get(order[1], day))
    groups = defaultdict(list)
    for key, order, amount in rows:
        groups[key].append((order, amount))
    out = {}
    for key, lines in groups.items():
        gmv, orders = sum(a for _, a in lines), {o[0]: o for o, _ in lines}
        customers = {o[1] for o in orders.values()} - {None}
        new = {o[1] for o in orders.values() if first[o[1]] == o[3][:10]} - {None}
        out[key] = (
            gmv, len(orders), len(customers), rounded(gmv, len(orders), 2), rounded(gmv, len(customers), 2),
            rounded(len(lines), len(orders), 2), rounded(len(new), len(customers), 4),
            mean(days(o[4], o[5]) for o in orders.values()), mean(days(o[3], o[5]) for o in orders.values()),
            mean([int(bool(o[5]) and o[5] > o[6]) for o in orders.values()], 4),
        )
    return out


@pytest.fixture(scope="module", params=[1, 2, 3])
def both(request, spark):
    made = Shop(request.param)
    orders, items = shop.orders(spark, *made.orders), shop.items(spark, *made.items)
    frames = {
        "fact": facts.order(orders, items, JANUARY).cache(),
        "payments": facts.payment(shop.payments(spark, *made.payments), orders, JANUARY),
        "reviews": facts.review(shop.reviews(spark, *made.reviews), orders, JANUARY),
        "products": dims.product(shop.products(spark, *made.categories.items()), shop.translation(spark, ("a", "A"))),
    }
    return made, frames


def _metrics(frame, key):
    return {k: tuple(row.values())[1:] for k, row in by(frame, key).items()}


def test_orders_by_date(both):
    made, frames = both
    found = _metrics(summaries.order_by_date(frames["fact"], ALL), "date_id")
    assert found == order_metrics([(o[3][:10], o, amount) for o, _, amount in made.fact()])


def test_orders_by_category(both):
    made, frames = both
    found = _metrics(summaries.order_by_category(frames["fact"], frames["products"], ALL), "cate_name")
    named = {p: {"a": "A"}.get(c, c) for p, c in made.categories.items()}
    assert found == order_metrics([(named[p], o, amount) for o, p, amount in made.fact() if p in named])


@pytest.mark.parametrize("once", [True, False])
def test_payments_by_date(both, once):
    made, frames = both
    lines = defaultdict(int)
    for o, _, _ in made.fact():
        lines[o[0]] += 1
    orders = {o[0]: o for o in made.orders}
    groups = defaultdict(list)
    for o, number, _, parts, value in made.payments:
        if number >= 1 and value is not None and lines[o] and orders[o][1] is not None:
            groups[orders[o][3][:10]] += [(o, number, parts or 1, Decimal(value))] * (1 if once else lines[o])
    expected = {}
    for day, rows in groups.items():
        total, split = sum(v for *_, v in rows), [r for r in rows if r[2] > 1]
        tries = {o: max(n for p, n, *_ in rows if p == o) for o, *_ in rows}
        expected[day] = (
            total, len(rows), rounded(len(split), len(rows), 4), rounded(sum(v for *_, v in split), total, 4),
            mean([parts for _, _, parts, _ in split]), mean(tries.values()),
        )
    found = _metrics(summaries.payment_by_date(frames["payments"], frames["fact"], ALL, grain_safe=once), "date_id")
    assert found == expected


@pytest.mark.parametrize("once", [True, False])
def test_reviews_by_date(both, once):
    made, frames = both
    lines = defaultdict(int)
    for o, _, _ in made.fact():
        lines[o[0]] += 1
    orders = {o[0]: o for o in made.orders}
    groups = defaultdict(list)
    for _, o, score, text, created, answered in made.reviews:
        if score and JANUARY.start <= created < JANUARY.end and lines[o] and orders[o][1] is not None:
            hours = None
            if answered:
                gap = datetime.fromisoformat(answered) - datetime.fromisoformat(created)
                hours = int(rounded(gap // timedelta(minutes=1), 60, 0))
            groups[created[:10]] += [(score, hours, text)] * (1 if once else lines[o])
    expected = {
        day: (
            len(rows), mean([r[0] for r in rows]), mean([int(r[0] >= 4) for r in rows], 4),
            mean([int(r[1] is not None) for r in rows], 4), mean([r[1] for r in rows]),
            mean([int(bool(r[2])) for r in rows], 4),
        )
        for day, rows in groups.items()
    }
    found = _metrics(summaries.review_by_date(frames["reviews"], frames["fact"], ALL, grain_safe=once), "date_id")
    assert found == expected
