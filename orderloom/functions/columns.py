"""Scalar rules: days, durations, flags, exact money sums and rounded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the cleaning rules.
VOID_STATUSES = ("unavailable", "canceled")
MIN_SCORE, MAX_SCORE = 1, 5
BAD_SCORE_MAX, NEUTRAL_SCORE, GOOD_SCORE_MIN = 2, 3, 4
SCORE_BUCKETS = {"bad": 1, "neutral": 2, "good": 3}

MONEY = "decimal(28,2)"
MEAN = "decimal(10,2)"
RATE = "decimal(10,4)"
_PLACES = {MEAN: 2, RATE: 4}
_WHOLE = "decimal(38,0)"


def day_id(time: str | Column) -> Column:
    """Day of a timestamp as ``yyyy-MM-dd`` text."""
    return F.to_date(time).cast("string")


def days_between(start: str, end: str) -> Column:
    """Calendar days from start to end; the time of day does not count."""
    return F.datediff(F.to_date(end), F.to_date(start))


def minutes_between(start: str, end: str) -> Column:
    """Whole minutes from start to end, cut toward zero.

    The interval is narrowed instead of using ``timestampdiff``, which would
    convert zone-less timestamps through the session time zone.
    """
    return (F.col(end) - F.col(start)).cast("interval minute").cast("long")


def hours_to_reply(created: str, answered: str) -> Column:
    """Minutes to hours, half away from zero."""
    return F.round(minutes_between(created, answered) / F.lit(60.0), 0).cast("int")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def is_overtime() -> Column:
    return flag(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))


def valid_status(status: str = "order_status") -> Column:
    """Unknown status compares to NULL and is dropped with the void ones."""
    return ~F.col(status).isin(*VOID_STATUSES)


def valid_amount(amount: str) -> Column:
    """Not negative; an unknown amount compares to NULL and is dropped."""
    return F.col(amount) >= 0


def valid_score(score: str = "review_score") -> Column:
    return F.col(score).between(MIN_SCORE, MAX_SCORE)


def score_bucket(score: str = "review_score") -> Column:
    value = F.col(score)
    return (
        F.when(value <= BAD_SCORE_MAX, SCORE_BUCKETS["bad"])
        .when(value == NEUTRAL_SCORE, SCORE_BUCKETS["neutral"])
        .otherwise(SCORE_BUCKETS["good"])
    )


def has_text(text: str) -> Column:
    """Blank space counts as text; NULL and the empty string do not."""
    return flag(F.col(text) != "")


def repaired_installments(installments: str = "payment_installments") -> Column:
    value = F.col(installments)
    return F.when(value == 0, 1).otherwise(value)


def cents(amount: str | Column) -> Column:
    """Exact whole cents: 64-bit sums stay in generated code and raise on overflow."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return (amount * 100).cast("long")


def whole(number: str | Column) -> Column:
    """A whole number wide enough for totals that 64 bits cannot hold."""
    number = F.col(number) if isinstance(number, str) else number
    return number.cast(_WHOLE)


def money(total_cents: str | Column) -> Column:
    return (whole(total_cents) * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def _rounded(part: Column, count: Column) -> Column:
    """part / count to the nearest whole number, half away from zero; NULL where count is 0.

    Whole-number division is exact at any size. A decimal quotient keeps few
    places when its operands are wide, and would be rounded twice.
    """
    part, count = whole(part), whole(count)
    size = F.call_function("div", F.abs(part) * 2 + count, F.nullif(count, F.lit(0)) * 2)
    return F.when(part < 0, -size).otherwise(size)


def ratio(part: str, total: str, to: str = RATE) -> Column:
    """part / total at the places of ``to``."""
    unit = 10 ** _PLACES[to]
    return (_rounded(whole(part) * unit, F.col(total)).cast("decimal(20,0)") / unit).cast(to)


def mean_money(total_cents: str, count: str) -> Column:
    """Mean amount of ``count`` units whose cents add up to ``total_cents``."""
    return money(_rounded(F.col(total_cents), F.col(count)))
